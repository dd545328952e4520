"""A listing page made from manifest rows."""

from __future__ import annotations

from html import escape

UNITS = ["B", "KiB", "MiB", "GiB"]


def human_size(n: int) -> str:
    i = 0
    size = float(n)
    while size >= 1024 and i < len(UNITS) - 1:
        size, i = size / 1024, i + 1
    return f"{n} B" if i == 0 else f"{size:.1f} {UNITS[i]}"


def row(chart: dict) -> str:
    cells = [chart.get("name") or chart.get("layer") or "", chart.get("source_edition") or "", human_size(chart["bytes"]), chart.get("processing") or "none", chart["sha256"]]
    link = f'<a href="{escape(chart["filename"], quote=True)}">{escape(chart["filename"])}</a>'
    return "<tr><td>" + link + "</td>" + "".join(f"<td>{escape(str(c))}</td>" for c in cells) + "</tr>"


def index_page(manifest: dict, order: list[str] = ()) -> str:
    """HTML; layers in the given order first, the others by file name."""
    place = {layer: i for i, layer in enumerate(order)}
    charts = sorted(manifest["charts"], key=lambda c: (place.get(c.get("layer"), len(place)), c["filename"]))
    head = "".join(f"<th>{h}</th>" for h in ("File", "Name", "Edition", "Size", "Processing", "SHA-256"))
    return f"<!doctype html><meta charset=\"utf-8\"><title>Charts</title><p>Generated {escape(manifest['generated'])}</p><table><tr>{head}</tr>{''.join(map(row, charts))}</table>\n"
