"""Publishing on a temporary folder."""

import json
import sqlite3

import pytest

from quadloom.plans import publish, site
from quadloom.sources import mbtiles
from quadloom.sources.files import Damaged


def archive(path, edition="2026-06-02", layer="Harbour Charts", **meta):
    mbtiles.set_metadata(path, {"source_layer": layer, "source_updated": edition, "name": "Harbours", **meta})
    with sqlite3.connect(path) as db:
        db.execute("INSERT INTO tiles VALUES (3, 0, 0, x'00')")
    return path


def test_publish_writes_manifest_and_index(tmp_path):
    out = tmp_path / "out"
    out.mkdir()
    archive(out / "fi-harbourcharts-2025-01-01.mbtiles", "2025-01-01")
    archive(out / "fi-other-2025-01-01.mbtiles", "2025-01-01", "other")
    (out / "unrelated.txt").write_text("x")
    m = publish.publish([archive(tmp_path / "a.mbtiles", nodata_stripped="n", downscaled="1", downscale_source_zoom="12")], out, "v1")
    assert [c["filename"] for c in m["charts"]] == ["fi-harbourcharts-2026-06-02.mbtiles", "fi-other-2025-01-01.mbtiles"]
    assert m["charts"][0]["processing"] == "n; downscaled from z12 (?)"
    assert json.loads((out / "manifest.json").read_text()) == m
    assert "fi-harbourcharts-2026-06-02.mbtiles" in (out / "index.html").read_text()
    assert not (out / "fi-harbourcharts-2025-01-01.mbtiles").exists() and (out / "unrelated.txt").exists()
    assert not list(out.glob(".*partial"))


def test_newer_editions_are_never_retired(tmp_path):
    out = tmp_path / "out"
    out.mkdir()
    archive(out / "fi-harbourcharts-2027-01-01.mbtiles", "2027-01-01")
    publish.publish([archive(tmp_path / "a.mbtiles")], out)
    assert len(list(out.glob("*.mbtiles"))) == 2


@pytest.mark.parametrize("meta", [{"source_updated": ""}, {"pyramid_pending": "3"}, {"source_updated": "June"}])
def test_unpublishable_leaves_everything(tmp_path, meta):
    out = tmp_path / "out"
    out.mkdir()
    with pytest.raises(publish.Unpublishable):
        publish.publish([archive(tmp_path / "a.mbtiles", **{"edition": "2026-06-02", **{k: v for k, v in meta.items() if k != "source_updated"}}) if "source_updated" not in meta else archive(tmp_path / "a.mbtiles", meta["source_updated"])], out)
    assert not list(out.iterdir())


def test_two_of_one_layer_missing_and_damaged_are_refused(tmp_path):
    out = tmp_path / "out"
    out.mkdir()
    a, b = archive(tmp_path / "a.mbtiles"), archive(tmp_path / "b.mbtiles", "2026-07-02")
    with pytest.raises(publish.Unpublishable, match="one layer"):
        publish.publish([a, b], out)
    with pytest.raises(publish.Unpublishable, match="missing"):
        publish.publish([a, tmp_path / "c.mbtiles"], out)
    b.write_bytes(b.read_bytes()[:5000])
    with pytest.raises(Damaged):
        publish.publish([b], out)
    assert not list(out.iterdir())


def test_sweep(tmp_path):
    (tmp_path / "a.partial").write_text("")
    (tmp_path / ".b.partial").write_text("")
    assert publish.sweep(tmp_path) == [".b.partial", "a.partial"] and not list(tmp_path.iterdir())


@pytest.mark.parametrize(("n", "want"), [(0, "0 B"), (1023, "1023 B"), (1024, "1.0 KiB"), (1280, "1.2 KiB"), (245_039_104, "233.7 MiB"), (5 << 40, "5120.0 GiB")])
def test_human_size(n, want):
    assert site.human_size(n) == want


def test_page_is_escaped():
    chart = {"filename": "a.mbtiles", "layer": "l", "name": "<b>&", "bytes": 1, "sha256": "0", "source_edition": None, "processing": None}
    page = site.index_page({"generated": "now", "charts": [chart]})
    assert "&lt;b&gt;&amp;" in page and "<b>&" not in page


def test_files_of_others_stay_and_unreadable_ones_are_passed_over(tmp_path):
    out = tmp_path / "out"
    out.mkdir()
    archive(out / "fi-harbourcharts-2025-01-01.mbtiles", "2025-01-01", "Somebody Else")  # another layer by its metadata
    archive(out / "fi-variant-2025-02-02.mbtiles", "2025-02-02")  # of the layer, under another name
    (out / "fi-broken-2025-01-01.mbtiles").write_bytes(b"not a database" * 50)
    m = publish.publish([archive(tmp_path / "a.mbtiles")], out)
    assert [c["filename"] for c in m["charts"]] == ["fi-harbourcharts-2025-01-01.mbtiles", "fi-harbourcharts-2026-06-02.mbtiles"]
    assert sorted(f.name for f in out.glob("*.mbtiles")) == ["fi-broken-2025-01-01.mbtiles", "fi-harbourcharts-2025-01-01.mbtiles", "fi-harbourcharts-2026-06-02.mbtiles"]


def test_names_come_from_the_layer_key_and_its_slug(tmp_path):
    out = tmp_path / "out"
    out.mkdir()
    m = publish.publish([archive(tmp_path / "a.mbtiles", layer="ignored", wmts_layer="Coast Charts public")], out)
    assert [c["filename"] for c in m["charts"]] == ["fi-coastcharts-2026-06-02.mbtiles"]
    (tmp_path / "b.mbtiles").write_bytes((tmp_path / "a.mbtiles").read_bytes() + b"\0" * 4096)
    publish.check_intact(tmp_path / "b.mbtiles")  # longer than its header says
