"""The template of map documents: styles that people may edit, and samples from which a document learns which style a kind of placemark has."""

from __future__ import annotations

import math
from dataclasses import dataclass
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

from ..functions import geometry as G
from ..operators.progression import BAND_NAMES
from .files import read_text, write_text

KML = "http://www.opengis.net/kml/2.2"
HEAD = f'<?xml version="1.0" encoding="UTF-8"?><kml xmlns="{KML}" xmlns:gx="http://www.google.com/kml/ext/2.2"><Document>'
TAIL = "</Document></kml>"
LATEST_FOLDER, PROGRESSION_FOLDER = "Latest Perimeters w/ Progression Outlines", "Perimeter Progression Maps"
POINT, INTERIOR = "Point Location", "Interior"
OUTLINES = ("Latest Perimeter", "Penultimate Perimeter", "Antepenultimate Perimeter")
#: Name, style, colour, side in metres, side of the hole.
_FILL = (INTERIOR, "perimeter-fill", "#FF0000", 800, None)
_OUTLINED = tuple((name, f"perimeter-outline-{k + 1}", color, 800 - 100 * k, None) for k, (name, color) in enumerate(zip(OUTLINES, ("#FF0000", "#FFFF00", "#FFFFFF"))))
_COLORS = ("#FF2A00", "#FF7300", "#FFAA00", "#B35933", "#6E473B", "#4A4A4A", "#7A828A", "#B0B7BD")
_BANDS = tuple((name, f"days-fill-{k + 1}", color, 800 - 100 * k, 700 - 100 * k or None) for k, (name, color) in enumerate(zip(BAND_NAMES, _COLORS)))
_CENTER = (10.869791666666668, 45.66499166666667)
_ICON = "http://maps.google.com/mapfiles/kml/shapes/firedept.png"


@dataclass(frozen=True)
class Template:
    """Style elements as text, and the style of each sample by its name."""

    styles: tuple[str, ...]
    urls: dict[str, str]


def color(rgb: str, percent: int) -> str:
    return f"{percent * 255 // 100:02x}{rgb[5:7]}{rgb[3:5]}{rgb[1:3]}".lower()


def style_xml(style_id: str, icon: str | None = None, line: tuple[str, float] | None = None, fill: tuple[str, int, int] | None = None) -> str:
    parts = [f"<IconStyle><Icon><href>{escape(icon)}</href></Icon></IconStyle>"] if icon else []
    if line:
        parts.append(f"<LineStyle><color>{line[0]}</color><width>{line[1]}</width></LineStyle>")
    if fill:
        parts.append(f"<PolyStyle><color>{fill[0]}</color><fill>{fill[1]}</fill><outline>{fill[2]}</outline></PolyStyle>")
    return f"<Style id={quoteattr(style_id)}>{''.join(parts)}</Style>"


def square(side: float, center: tuple[float, float]) -> list[tuple[float, float]]:
    """A closed square around a place, its corners by geodesics of half its diagonal."""
    corners = [G.geodesic_forward(*center, azimuth, side * math.sqrt(2) / 2) for azimuth in (315.0, 45.0, 135.0, 225.0)]
    return [*corners, corners[0]]


def _ring(points: list[tuple[float, float]]) -> str:
    return "<LinearRing><coordinates>" + " ".join(f"{x!r},{y!r},0.0" for x, y in points) + "</coordinates></LinearRing>"


def _sample(name: str, style: str, side: float, hole: float | None, center: tuple[float, float], order: int) -> str:
    inner = f"<innerBoundaryIs>{_ring(square(hole, center)[::-1])}</innerBoundaryIs>" if hole else ""
    shape = f"<Polygon><gx:drawOrder>{order}</gx:drawOrder><outerBoundaryIs>{_ring(square(side, center))}</outerBoundaryIs>{inner}</Polygon>"
    return f"<Placemark><name>{escape(name)}</name><styleUrl>#{style}</styleUrl>{shape}</Placemark>"


def _point(center: tuple[float, float], order: int) -> str:
    return f"<Placemark><name>{POINT}</name><styleUrl>#point-icon</styleUrl><Point><gx:drawOrder>{order}</gx:drawOrder><coordinates>{center[0]!r},{center[1]!r},0.0</coordinates></Point></Placemark>"


def template_text() -> str:
    """The template as first written: a sample square for each kind of perimeter, the latest ones two kilometres west of the bands."""
    styles = [style_xml("point-icon", icon=_ICON)]
    styles += [style_xml(style, fill=(color(rgb, 50), 1, 0)) for _, style, rgb, *_ in (_FILL, *_BANDS)]
    styles += [style_xml(style, line=(color(rgb, 100), 1.5), fill=(color("#FFFFFF", 0), 1, 1)) for _, style, rgb, *_ in _OUTLINED]
    west = G.geodesic_forward(*_CENTER, 270.0, 2000)
    latest = _point(west, len(_OUTLINED) + 1) + _sample(*_FILL[:2], *_FILL[3:], west, 0)
    latest += "".join(_sample(name, style, side, hole, west, len(_OUTLINED) - k) for k, (name, style, _, side, hole) in enumerate(_OUTLINED))
    rings = _point(_CENTER, len(_BANDS)) + "".join(_sample(name, style, side, hole, _CENTER, len(_BANDS) - 1 - k) for k, (name, style, _, side, hole) in enumerate(_BANDS))
    folders = "".join(f"<Folder><name>{escape(name)}</name>{body}</Folder>" for name, body in ((LATEST_FOLDER, latest), (PROGRESSION_FOLDER, rings)))
    return HEAD + "".join(styles) + folders + TAIL


def create_template(spark, path: str, force: bool = False) -> bool:
    """Write the template; False if there is one, as it may have been edited, unless forced."""
    return write_text(spark, path, template_text(), overwrite=force)


def _style(element: ElementTree.Element) -> str:
    tag = lambda name: f"{{{KML}}}{name}"
    name = element.get("id")
    if name is None:
        raise ValueError("a style of the template has no id")
    find = lambda path: element.findtext("/".join(tag(p) for p in path.split("/")))
    line = (find("LineStyle/color") or "ffffffff", float(find("LineStyle/width") or 1)) if element.find(tag("LineStyle")) is not None else None
    poly = (find("PolyStyle/color") or "ffffffff", int(find("PolyStyle/fill") or 1), int(find("PolyStyle/outline") or 1)) if element.find(tag("PolyStyle")) is not None else None
    return style_xml(name, find("IconStyle/Icon/href"), line, poly)


def parse_template(text: str) -> Template:
    """Styles of the document, and the style of each named placemark in it or in its folders; of equal names the last counts."""
    document = ElementTree.fromstring(text).find(f"{{{KML}}}Document")
    if document is None:
        raise ValueError("the template has no document")
    urls: dict[str, str] = {}

    def walk(element: ElementTree.Element) -> None:
        for child in element:
            if child.tag == f"{{{KML}}}Folder":
                walk(child)
            elif child.tag == f"{{{KML}}}Placemark":
                name, url = (child.findtext(f"{{{KML}}}{x}") for x in ("name", "styleUrl"))
                if name is not None and url is not None:
                    urls[name] = url

    walk(document)
    return Template(tuple(_style(e) for e in document if e.tag == f"{{{KML}}}Style"), urls)


def read_template(spark, path: str) -> Template:
    return parse_template(read_text(spark, path))
