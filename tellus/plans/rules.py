"""The declared constraints of the clean tables (section 2.12, X1-X11), as
rules for ``operators.validate``: one set per table, and the foreign keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from tellus.operators import validate as V
from tellus.operators.validate import Rule

# Lengths, precisions, bounds and sets of the table definitions.
ID, TITLE, CATEGORY_TITLE, URL, TYPE = 50, 255, 100, 255, 20
GEOMETRY_TYPES = ("Point", "Polygon")
PHASES = ("before", "after")

#: Foreign keys: (parent table, child column, parent column).
PARENTS = {
    "geometry": [("event", "event_id", "id")],
    "event_category": [("event", "event_id", "id"), ("category", "category_id", "id")],
    "event_source": [("event", "event_id", "id"), ("source", "source_id", "id")],
    "event_earthquake": [("event", "event_id", "id"), ("earthquake", "earthquake_id", "id")],
}


def table_rules(name: str) -> list[Rule]:
    """The row rules of a clean table."""
    if name == "event":
        return [*V.not_null("id", "title", "link"), V.max_length("id", ID), V.max_length("title", TITLE),
                V.not_blank("title"), V.max_length("link", URL), V.url("link")]
    if name == "category":
        return [*V.not_null("id", "title"), V.max_length("id", ID), V.max_length("title", CATEGORY_TITLE), V.not_blank("title")]
    if name == "source":
        return [*V.not_null("id", "url"), V.max_length("id", ID), V.max_length("url", URL), V.url("url")]
    if name == "geometry":
        return [*V.not_null("event_id", "date", "type", "coordinates"), V.max_length("event_id", ID), V.max_length("type", TYPE),
                V.one_of("type", GEOMETRY_TYPES), V.point_geometry()]
    if name in ("event_category", "event_source"):
        other = "category_id" if name == "event_category" else "source_id"
        return [*V.not_null("event_id", other), V.max_length("event_id", ID), V.max_length(other, ID)]
    if name == "earthquake":
        return [*V.not_null("id", "time", "longitude", "latitude", "tsunami"), V.max_length("id", ID), V.max_length("mag_type", TYPE),
                V.fits_decimal("magnitude", 4, 2), V.fits_decimal("longitude", 9, 5), V.fits_decimal("latitude", 8, 5),
                V.fits_decimal("depth_km", 7, 3), V.between("longitude", -180, 180), V.between("latitude", -90, 90),
                Rule("range:magnitude", F.col("magnitude").isNull() | F.col("magnitude").between(-1, 10)),
                V.max_length("url", URL), Rule("url:url", F.col("url").isNull() | F.col("url").rlike("^https?://"))]
    if name == "event_earthquake":
        return [*V.not_null("event_id", "earthquake_id"), V.fits_decimal("distance_km", 8, 2), V.fits_decimal("delay_hours", 8, 2)]
    if name == "report":
        return [*V.not_null("run_id", "phase", "control_id"), V.one_of("phase", PHASES)]
    raise KeyError(name)
