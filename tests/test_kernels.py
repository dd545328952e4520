"""Raster kernels and the PNG codec without Spark."""

import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quadloom.functions import png, raster

PAPER, SEA, BLACK, WHITE = (236, 228, 205, 255), (198, 226, 240, 255), (0, 0, 0, 255), (255, 255, 255, 255)


def tile(colour, side=256):
    a = np.empty((side, side, 4), np.uint8)
    a[:] = colour
    return a


@settings(max_examples=25, deadline=None)
@given(st.integers(1, 9), st.integers(1, 9), st.integers(0, 2**32 - 1))
def test_png_round_trip(h, w, seed):
    a = np.random.default_rng(seed).integers(0, 256, (h, w, 4), dtype=np.uint8)
    assert (png.decode(png.encode(a)) == a).all()


@pytest.mark.parametrize("kind", range(5))
def test_png_filters(kind):
    a = np.random.default_rng(kind).integers(0, 256, (6, 5, 4), dtype=np.uint8)
    flat = a.reshape(6, 20).astype(int)
    lines = []
    for y in range(6):
        up = flat[y - 1] if y else np.zeros(20, int)
        left = np.concatenate([np.zeros(4, int), flat[y][:-4]])
        corner = np.concatenate([np.zeros(4, int), up[:-4]])
        p = left + up - corner
        d = np.stack([abs(p - left), abs(p - up), abs(p - corner)])
        paeth = np.choose(d.argmin(axis=0), [left, up, corner])
        lines.append(bytes([kind]) + bytes(((flat[y] - [0, left, up, (left + up) // 2, paeth][kind]) & 255).astype(np.uint8)))
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    blob = png.SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", 5, 6, 8, 6, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(lines))) + chunk(b"IEND", b"")
    assert (png.decode(blob) == a).all()


def test_png_rejects_other_bytes():
    with pytest.raises(ValueError):
        png.decode(b"tile")


@pytest.mark.parametrize("radius", [1, 2, 3, 5, 8])
def test_distance_equals_brute_force(radius):
    target = np.random.default_rng(radius).random((30, 34)) < 0.03
    at = np.argwhere(target)
    y, x = np.indices(target.shape)
    best = np.min([(y - a) ** 2 + (x - b) ** 2 for a, b in at], axis=0)
    assert (raster.far_from(target, radius) == (best > radius**2)).all()


def test_spread_equals_brute_force():
    rng = np.random.default_rng(3)
    within, seed = rng.random((40, 40)) < 0.6, rng.random((40, 40)) < 0.01
    seen = {tuple(p) for p in np.argwhere(seed & within)}
    todo = list(seen)
    while todo:
        y, x = todo.pop()
        for n in ((y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)):
            if 0 <= n[0] < 40 and 0 <= n[1] < 40 and within[n] and n not in seen:
                seen.add(n)
                todo.append(n)
    assert {tuple(p) for p in np.argwhere(raster.spread(seed, within))} == seen


def test_halving_truncates_and_weighs_by_alpha():
    a = np.array([[[10, 20, 30, 255], [11, 20, 30, 255]], [[11, 20, 30, 255], [11, 21, 30, 255]]], np.uint8)
    assert raster.halve(a)[0, 0].tolist() == [10, 20, 30, 255]
    a[0, 0, 3] = a[0, 1, 3] = a[1, 0, 3] = 0
    assert raster.halve(a)[0, 0].tolist() == [11, 21, 30, 63]


def test_halving_keeps_the_colour_under_transparency():
    a = tile((255, 255, 255, 0), 4)
    assert (raster.halve(a) == (255, 255, 255, 0)).all()


def test_missing_children_are_transparent_white():
    out = raster.parent_of({3: tile(SEA)})
    assert out[200, 200].tolist() == list(SEA) and out[10, 10].tolist() == [255, 255, 255, 0]
    assert raster.parent_of({0: tile((1, 2, 3, 0))}) is None


def test_fill_is_removed_from_the_outward_side_only():
    a = tile(PAPER)
    a[:, 106:] = BLACK
    mask = raster.no_data(a, "black")
    around = {s: np.zeros((256, 256), bool) for s in ("l", "t", "b", "lt", "lb")}
    gone = raster.removal(mask, around, 16, {"r", "rt", "rb"})
    assert gone[:, 130:].all() and not gone[:, :106].any()
    assert not raster.removal(mask, around, 16, {"l"}).any()


def test_thin_ink_survives():
    a = tile(PAPER)
    a[100:112, 20:230] = BLACK
    assert not raster.removal(raster.no_data(a, "black"), {}, 16, {"r"})[100:112, 60:200].any()


def test_all_no_data_around_goes_whole():
    assert raster.removal(np.ones((256, 256), bool), {}, 64, {"r"}).all()


def test_a_margin_beyond_the_neighbour_is_refused():
    with pytest.raises(ValueError):
        raster.padded(np.zeros((256, 256), bool), {}, 257)


def test_pads_sit_where_their_tiles_are():
    m = 4
    big = raster.padded(np.zeros((8, 8), bool), {s: np.zeros((8, 8), bool) for s in ("l", "r", "t", "b", "lt", "rt", "lb")}, m)
    assert big[-m:, -m:].all() and big.sum() == m * m


def test_fully_erased_tiles_are_dropped():
    assert raster.erased(tile(BLACK), np.ones((256, 256), bool)) is None


def test_masks():
    a = tile((0, 0, 0, 0))
    a[0, 0, 3] = 1
    m = raster.alpha_mask(a)
    assert m.sum() == 1 and raster.mask_quadrant(m, 0, 0).sum() == 4 and not raster.mask_quadrant(m, 1, 1).any()


def test_novelty_of_an_upscale_is_nil():
    rng = np.random.default_rng(1)
    parent = rng.integers(0, 256, (256, 256, 4), dtype=np.uint8)
    parent[..., 3] = 255
    child = raster.doubled(parent, 1, 0)
    assert raster.novelty(child, parent, 1, 0) == 0 and raster.same_share(child, parent, 1, 0) == 1
    assert raster.novelty(255 - child | np.array([0, 0, 0, 255], np.uint8), parent, 1, 0) > 0.5
    assert raster.novelty(tile((0, 0, 0, 0)), parent, 0, 0) is None


def test_smooth_doubling_of_a_flat_tile_is_flat():
    assert (raster.doubled(tile(SEA), 0, 1, smooth=True) == SEA).all()


@pytest.mark.parametrize("step", [1, 3, 4])
def test_every_mix_of_line_filters(step):
    rng = np.random.default_rng(step)
    h, w = 37, 21
    px = rng.integers(0, 256, (h, w, step)).astype(int)
    pad = np.pad(px, ((1, 0), (1, 0), (0, 0)))
    a, b, c = pad[1:, :-1], pad[:-1, 1:], pad[:-1, :-1]
    p = a + b - c
    best = np.array([abs(p - a), abs(p - b), abs(p - c)]).argmin(axis=0)
    guess = np.array([0 * a, a, b, (a + b) // 2, np.choose(best, [a, b, c])])
    kinds = rng.integers(0, 5, h)
    lines = np.concatenate([kinds[:, None], ((px - guess[kinds, np.arange(h)]) % 256).reshape(h, -1)], axis=1).astype(np.uint8)
    assert (png._unfilter(lines, step) == px.reshape(h, -1)).all()


def test_novelty_needs_something_to_see_and_minds_alpha():
    parent = tile((90, 90, 90, 255))
    child = tile((0, 0, 0, 0))
    child[0, 0] = (1, 2, 3, 255)
    assert raster.novelty(child, parent, 0, 0) is None
    child[:6] = (1, 2, 3, 255)
    assert raster.novelty(child, parent, 0, 0) == 1
    faint = tile((90, 90, 90, 100))
    assert raster.novelty(faint, parent, 0, 0) == 1 and raster.same_share(faint, parent, 0, 0) == 0
