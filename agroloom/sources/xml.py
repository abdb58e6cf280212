"""Dataset descriptions in XML: one row per document in, five tables out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _nodes(doc: Column, tag: str) -> Column:
    """All elements of one tag as XML fragments."""
    return F.regexp_extract_all(doc, F.lit(f"(?s)(<{tag}[\\s>].*?</{tag}>)"), F.lit(1))


def _text(fragment: Column, tag: str) -> Column:
    """Text of the first element of that name; null when absent. Prefixes are matched by name."""
    value = F.regexp_replace(F.xpath_string(fragment, F.lit(f'//*[name()="{tag}"]')), r"^\s+|\s+$", "")
    return F.nullif(value, F.lit(""))


def _table(
    docs: DataFrame, doc: str, by: list[str], node: str, fields: dict[str, str], shared: tuple[str, ...] = ()
) -> DataFrame:
    # a field stated once for the whole document applies to the nodes without their own; it is read before the
    # document is taken apart, so a node carries the short text and not the document
    common = [_text(F.col(doc), fields[n]).alias(f"__all_{n}") for n in shared]
    rows = docs.select(*by, *common, F.explode(_nodes(F.col(doc), node)).alias("__node"))
    own = {n: _text(F.col("__node"), tag) for n, tag in fields.items()}
    own |= {n: F.coalesce(own[n], F.col(f"__all_{n}")) for n in shared}
    return rows.select(*by, *[c.alias(n) for n, c in own.items()])


# Output field -> element, in the namespace prefixes of the catalogue standard.
PARTY_FIELDS = {
    "persons": "gmd:individualName",
    "organisation": "gmd:organisationName",
    "position": "gmd:positionName",
    "street": "gmd:deliveryPoint",
    "city": "gmd:city",
    "postal_code": "gmd:postalCode",
    "email": "gmd:electronicMailAddress",
}
COLUMN_FIELDS = {
    "tbl_name": "bnr:tableName",
    "name": "bnr:name",
    "description": "bnr:description",
    "methods": "bnr:methods",
    "unit": "bnr:unit",
    "data_type": "bnr:dataType",
    "missing_vals": "bnr:missingValue",
}
ELEMENT_FIELDS = {"name": "ShortName", "description": "Description", "unit": "UnitOfMeasurement"}


def read_metadata(docs: DataFrame, doc: str = "value", by: list[str] = ("path",)) -> dict[str, DataFrame]:
    """``Identification, Provenance, Spatial_coverage, Temporal_coverage, Variable_key``.

    ``docs`` has one document per row. Each table carries the ``by`` columns.
    """
    by = list(by)
    body = F.col(doc)
    extents = _nodes(body, "gmd:EX_Extent")
    ident = docs.select(*by, F.get(_nodes(body, "gmd:identificationInfo"), F.lit(0)).alias("n")).filter("n IS NOT NULL")
    space = docs.select(*by, F.get(extents, F.lit(0)).alias("n")).filter("n IS NOT NULL")
    time = docs.select(*by, F.get(extents, F.lit(1)).alias("n")).filter("n IS NOT NULL")

    def corner(name: str, lat: str, lon: str) -> Column:
        return F.struct(
            F.lit(name).alias("corner"),
            _text(F.col("n"), lat).try_cast("double").alias("latitude"),
            _text(F.col("n"), lon).try_cast("double").alias("longitude"),
        )

    corners = F.array(
        corner("SW", "gmd:southBoundLatitude", "gmd:westBoundLongitude"),
        corner("NE", "gmd:northBoundLatitude", "gmd:eastBoundLongitude"),
    )
    return {
        "Identification": ident.select(
            *by, _text(F.col("n"), "gmd:MD_Identifier").alias("doi"), _text(F.col("n"), "gmd:alternateTitle").alias("title")
        ),
        "Provenance": _table(docs, doc, by, "gmd:CI_ResponsibleParty", PARTY_FIELDS).distinct(),
        "Spatial_coverage": space.select(*by, F.explode(corners).alias("c")).select(*by, "c.*"),
        "Temporal_coverage": time.select(
            *by, _text(F.col("n"), "gml:beginPosition").alias("start"), _text(F.col("n"), "gml:endPosition").alias("end")
        ),
        "Variable_key": _table(docs, doc, by, "bnr:MD_Column", COLUMN_FIELDS, ("methods", "missing_vals")),
    }


def read_elements(docs: DataFrame, doc: str = "value", by: list[str] = ("path",)) -> DataFrame:
    """Variable key of a weather archive: name, description and unit per element."""
    return _table(docs, doc, list(by), "MetElement", ELEMENT_FIELDS)
