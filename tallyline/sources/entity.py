"""Landed accounting entity sets (JSON): S1, S2, S4, N1-N4, P1-P4, K5.

An entity set lands as JSON documents, either ``{"value": [records]}`` or a
bare ``[records]``. One read handles both: the schema has the ``value``
array *and* the record fields, so envelope documents fill ``value`` and
bare-list elements fill the record fields; ``inline`` turns either into
record rows. All raw fields are read as text (numbers and booleans keep
their JSON spelling) and typed afterwards by the column mapping (P2/P3).

Multi-line JSON files are not splittable (one task per file); large entity
sets should land as JSON lines, which this reader takes as well.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from ..functions.classify import categorize
from ..functions.coerce import coerce_by_word, coerce_datetime
from ..functions.sqlexpr import ident, lit


FAIL = "map('mode', 'FAILFAST')"  # a malformed document fails the run
MALFORMED, NO_RECORDS = "malformed", "no records"


@dataclass(frozen=True)
class Col:
    """One mapped column: source field -> target name, type word."""

    source: str
    target: str
    type_word: str = "string"


@dataclass(frozen=True)
class EntitySpec:
    """Declarative ingest config of one entity set (no code in config)."""

    name: str
    columns: tuple[Col, ...] = ()  # empty -> passthrough (S4)
    ref_key: str = "Ref_Key"
    explode_column: str = ""
    detail_columns: tuple[Col, ...] = ()
    header_table: str = ""
    detail_table: str = ""
    classify_detail: tuple = field(default=())  # line-category rules for the detail text
    detail_text: str = "nomenclature_text"

    @property
    def ref_target(self) -> str:
        for c in self.columns:
            if c.source == self.ref_key:
                return c.target
        return self.ref_key


def record_schema(spec: EntitySpec) -> StructType:
    """All fields as text; elements without a mapping of their own are maps of
    field name to text."""
    fields = [StructField(c.source, StringType()) for c in spec.columns]
    if spec.explode_column:
        detail = StructType([StructField(c.source, StringType()) for c in spec.detail_columns])
        detail = detail if spec.detail_columns else MapType(StringType(), StringType())
        fields = [f for f in fields if f.name != spec.explode_column]
        fields.append(StructField(spec.explode_column, ArrayType(detail)))
    return StructType(fields)


def envelope_schema(spec: EntitySpec) -> StructType:
    """``value`` is read as text where the records have a field of that name."""
    rec = record_schema(spec)
    own = [f for f in rec.fields if f.name == "value"]
    return StructType([StructField("value", StringType() if own else ArrayType(rec))] + [f for f in rec.fields if f.name != "value"])


def _record_arrays(spec: EntitySpec) -> tuple[str, str]:
    """SQL of a document's records, and of whether it is an entity set at all:
    an envelope with its array, or a bare record that has its key (or any
    field, where the key is not mapped). Error answers are neither."""
    rec = record_schema(spec)
    names = [f.name for f in rec.fields]
    envelope, inside = "value IS NOT NULL", "value"
    if "value" in names:
        envelope = "ltrim(value) LIKE '[%'"
        inside = f"from_json(value, '{ArrayType(rec).simpleString()}', {FAIL})"
    keys = [spec.ref_key] if spec.ref_key in names else names
    bare = " OR ".join(f"{ident(k)} IS NOT NULL" for k in keys)
    records = f"CASE WHEN {bare} THEN array(struct({', '.join(map(ident, names))})) WHEN {envelope} THEN {inside} END"
    return records, f"({envelope} OR {bare})"


def _records(raw: DataFrame, spec: EntitySpec) -> DataFrame:
    records, usable = _record_arrays(spec)
    refuse = f"raise_error('{spec.name}: a document without records')"
    return raw.selectExpr(f"inline(IF({usable}, {records}, {refuse}))")


def read_documents(spark: SparkSession, path: str, spec: EntitySpec, multi_line: bool = True) -> DataFrame:
    """One row a landed document: ``file``, ``refused`` (why it is no entity
    set; else null), ``text`` (of a malformed one) and its ``records``."""
    schema = envelope_schema(spec).add("_malformed", StringType())
    reader = spark.read.schema(schema).option("multiLine", multi_line).option("mode", "PERMISSIVE")
    raw = reader.option("columnNameOfCorruptRecord", "_malformed").json(path)
    records, usable = _record_arrays(spec)
    refused = f"CASE WHEN _malformed IS NOT NULL THEN '{MALFORMED}' WHEN NOT {usable} THEN '{NO_RECORDS}' END"
    out = raw.selectExpr("_metadata.file_path AS file", f"{refused} AS refused", "_malformed AS text", f"{records} AS records")
    return out.selectExpr("file", "refused", "text", "IF(refused IS NULL, records, NULL) AS records")


def read_entity_files(spark: SparkSession, path: str, spec: EntitySpec, multi_line: bool = True) -> DataFrame:
    """S1 + S2: landed files -> raw record rows (only mapped fields read).
    S4: without a mapping, all fields with inferred types. A malformed or
    truncated document, or an answer that is no entity set, fails the run."""
    reader = spark.read.option("multiLine", multi_line).option("mode", "FAILFAST")
    if not spec.columns:
        return inferred_records(reader.json(path))
    return _records(reader.schema(envelope_schema(spec)).json(path), spec)


def inferred_records(raw: DataFrame) -> DataFrame:
    """Record rows of documents read with an inferred schema: those of the
    ``value`` array of envelopes, or the rows themselves. A folder that mixes
    both kinds needs a mapping."""
    kind = dict(raw.dtypes).get("value", "")
    if not kind.startswith("array<struct<"):
        return raw
    if bare := [c for c in raw.columns if c != "value" and not c.startswith("odata") and not c.startswith("@")]:
        raise ValueError(f"envelopes and bare records ({', '.join(bare)}) need a column mapping")
    return raw.selectExpr("inline(value)")


def parse_entity_text(df: DataFrame, text_col: str, spec: EntitySpec) -> DataFrame:
    """S1 on a text column of JSON documents (envelope or bare list)."""
    arr = ArrayType(record_schema(spec)).simpleString()
    t = ident(text_col)
    parsed = df.selectExpr(
        f"CASE WHEN ltrim({t}) LIKE '[%' THEN from_json({t}, '{arr}', {FAIL}) "
        f"ELSE from_json({t}, 'struct<value:{arr}>', {FAIL}).value END AS _docs"
    )
    return parsed.selectExpr("inline(_docs)")


def map_columns(records: DataFrame, cols, null_default: bool, cast: bool = True) -> DataFrame:
    """P1 (+P2/P3/P4): select + rename by mapping, then type by word."""
    out = []
    for c in cols:
        src = ident(c.source)
        out.append(f"{coerce_by_word(src, c.type_word, null_default) if cast else src} AS {ident(c.target)}")
    return records.selectExpr(*out)


def header_rows(records: DataFrame, spec: EntitySpec, null_default: bool = True, cast: bool = True) -> DataFrame:
    """N4 + P1/P2: the header table (the array column dropped)."""
    if not spec.columns:  # S4: passthrough of the raw fields
        return records
    cols = [c for c in spec.columns if c.source != spec.explode_column]
    return map_columns(records, cols, null_default, cast)


def detail_rows(records: DataFrame, spec: EntitySpec, null_default: bool = True) -> DataFrame:
    """N1 + N2 (+N3): explode the array with its parent key, keep one row for
    an empty / NULL array (C17), flatten, rename and type the elements."""
    if not spec.explode_column:
        raise ValueError(f"{spec.name}: no explode column configured")
    ref = spec.ref_key
    if ref not in records.columns:  # N3, checked before the job runs
        raise ValueError(f"{spec.name}: parent key {ref!r} not among the record fields")
    exploded = records.selectExpr(
        f"{ident(ref)} AS {ident(spec.ref_target)}", f"explode_outer({ident(spec.explode_column)}) AS _e"
    )
    if not spec.detail_columns:  # all element fields, as they are
        return _unmapped_elements(exploded, spec)
    flat = exploded.selectExpr(ident(spec.ref_target), "_e.*")
    out = [ident(spec.ref_target)] + [
        f"{coerce_by_word(ident(c.source), c.type_word, null_default)} AS {ident(c.target)}" for c in spec.detail_columns
    ]
    rows = flat.selectExpr(*out)
    if spec.classify_detail:
        rows = rows.withColumn(
            "nomenclature_text_gr", F.expr(categorize(ident(spec.detail_text), spec.classify_detail))
        )
    return rows


def _unmapped_elements(exploded: DataFrame, spec: EntitySpec) -> DataFrame:
    """Element fields under their own names. Of maps, the distinct field names
    are gathered first (as many as the set has fields, not rows)."""
    if not exploded.schema["_e"].dataType.simpleString().startswith("map"):
        return exploded.selectExpr(ident(spec.ref_target), "_e.*")
    names = exploded.selectExpr("explode(map_keys(_e)) AS n").distinct().orderBy("n").collect()
    return exploded.selectExpr(ident(spec.ref_target), *[f"_e[{lit(r.n)}] AS {ident(r.n)}" for r in names if r.n != spec.ref_target])


def ingest(records: DataFrame, spec: EntitySpec) -> tuple[DataFrame, DataFrame | None]:
    """S1-S4 + N1-N4: (header, detail) DataFrames of one entity set."""
    header = header_rows(records, spec)
    detail = detail_rows(records, spec) if spec.explode_column else None
    return header, detail


def incremental_records(records: DataFrame, source_field: str, cutoff) -> DataFrame:
    """S3 on whole documents, before the header and detail rows are made, so
    that the lines of excluded documents stay out too."""
    return records.where(f"{coerce_datetime(ident(source_field))} > {lit(cutoff)}")


def incremental(header: DataFrame, date_col: str, cutoff) -> DataFrame:
    """S3: rows strictly after the cut-off (pushed to the scan when the
    column is stored typed)."""
    return header.where(f"{ident(date_col)} > {lit(cutoff)}")
