"""S7 + K5: from landed files to the tables the daily run reads.

Every entity set is read and parsed once, written to the shared checkpoint
folder, and from there to its header and detail tables; the terms sheet
becomes a table of its own. ``table_inputs`` then gives the daily run its
inputs from those tables.

Documents and records are counted while they are parsed (``Observation``). A
landing with a document that is no entity set (malformed, or an error answer)
changes no table; the document is listed in the quarantine table. Sets load
side by side, and one that fails does not keep the others from loading.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.coerce import coerce_datetime
from ..functions.sqlexpr import ident, lit
from ..session import materialize_shared, remove_paths
from ..sinks import tables, upsert
from ..sources import entity, sheet
from ..sources.entity import Col, EntitySpec
from .pipeline import INPUT_TABLES, Inputs


@dataclass(frozen=True)
class Landing:
    """One landed entity set. With a cut-off only documents dated after it
    are taken; they are merged by their key, so a repeated load changes
    nothing."""

    spec: EntitySpec
    path: str
    multi_line: bool = True
    cutoff_field: str | None = None
    cutoff: object = None


def landings_from_json(text: str) -> list[Landing]:
    """Configuration as data: a list of objects with ``path`` and the fields
    of ``EntitySpec``; columns are [source, target, type] triples."""
    import datetime as _dt

    out = []
    for raw in json.loads(text):
        own = {k: raw.pop(k) for k in ("path", "multi_line", "cutoff_field", "cutoff") if k in raw}
        if own.get("cutoff"):
            own["cutoff"] = _dt.datetime.fromisoformat(own["cutoff"])
        for k in ("columns", "detail_columns"):
            raw[k] = tuple(Col(*c) for c in raw.get(k, ()))
        out.append(Landing(EntitySpec(**raw), **own))
    return out


QUARANTINE = "ingest_quarantine"
#: entity sets that load at the same time
PARALLEL = 4


class Refused(ValueError):
    """A landing holds documents that are no entity set."""


class IngestError(RuntimeError):
    """Some sets failed (``errors`` by set name); ``written`` are the rest's tables."""

    def __init__(self, errors: dict[str, Exception], written: dict[str, str]):
        super().__init__("; ".join(f"{k}: {e}" for k, e in sorted(errors.items())))
        self.errors, self.written = errors, written


def _accepted(documents: DataFrame, name: str, database: str, made: list[str]) -> tuple[DataFrame, dict]:
    """The records of the documents, parsed and counted in one pass; stops on
    refused documents, which are listed."""
    seen = Observation(f"landed-{name}")
    counted = documents.observe(
        seen,
        F.count("*").alias("documents"),
        F.count("refused").alias("refused"),
        F.coalesce(F.sum(F.size("records")), F.lit(0)).alias("records"),
    )
    staged = materialize_shared(counted, f"landed-{name}", made)
    counts = seen.get
    if counts["refused"]:
        listed = staged.where("refused IS NOT NULL").selectExpr(f"{lit(name)} AS entity", "file", "refused", "text", "current_timestamp() AS at")
        tables.append(listed, f"{database}.{QUARANTINE}")
        raise Refused(f"{counts['refused']} of {counts['documents']} documents are no entity set, see {database}.{QUARANTINE}")
    records = staged.selectExpr("inline(records)")
    if (found := records.count()) != counts["records"]:
        raise ValueError(f"{found} records out of {counts['records']}")
    return records, counts


def _merge(records: DataFrame, x: Landing, header_table: str, detail_table: str, made: list[str]) -> None:
    """S3: the documents after the cut-off replace their earlier versions."""
    spec = x.spec
    records = entity.incremental_records(records, x.cutoff_field, x.cutoff)
    if not records.where(f"{ident(spec.ref_key)} IS NULL").isEmpty():
        raise Refused(f"documents without {spec.ref_key} cannot be merged")
    dated = coerce_datetime(ident(x.cutoff_field))
    latest = materialize_shared(upsert.latest_versions(records, spec.ref_key, [dated]), f"latest-{spec.name}", made)
    header, detail = entity.ingest(latest, spec)
    key = spec.ref_target
    parts = latest.selectExpr(f"{ident(spec.ref_key)} AS {ident(key)}", f"{upsert.month_of(dated)} AS {upsert.PART}")
    old = None
    if tables.table_exists(latest.sparkSession, header_table):
        earlier = latest.sparkSession.table(header_table)
        own = next((c for c in spec.columns if c.source == x.cutoff_field), None)
        month = upsert.month_of(ident(own.target)) if own else f"'{upsert.NO_MONTH}'"
        month = ident(upsert.PART) if upsert.PART in earlier.columns else month
        old = earlier.selectExpr(ident(key), f"{month} AS {upsert.PART}").distinct()
    if detail is not None and detail_table:
        upsert.merge_by_key(detail.join(parts, key), detail_table, key, old)
    upsert.merge_by_key(header.join(parts, key), header_table, key, old)


def load(spark: SparkSession, x: Landing, database: str) -> dict[str, str]:
    """One landed set into its tables; table names."""
    spec, made = x.spec, []
    names = [spec.header_table or spec.name, spec.detail_table]
    full = [f"{database}.{n}" if n else "" for n in names]
    merge = bool(x.cutoff_field and x.cutoff is not None)
    batch = upsert.fingerprint(spark, x.path, spec, x.cutoff_field, x.cutoff) if merge else ""
    if not (merge and upsert.applied(spark, database, spec.name, batch)):
        if not spec.columns:
            records = materialize_shared(entity.read_entity_files(spark, x.path, spec, x.multi_line), f"landed-{spec.name}", made)
            counts = {"documents": 0, "records": records.count()}
        else:
            records, counts = _accepted(entity.read_documents(spark, x.path, spec, x.multi_line), spec.name, database, made)
        if merge:
            _merge(records, x, *full, made)
            upsert.note_applied(spark, database, spec.name, batch, counts["documents"], counts["records"])
        else:
            tables.write_header_detail(*entity.ingest(records, spec), *full, expect=counts["records"])
        remove_paths(spark, made)
    return {n: t for n, t in zip(names, full, strict=True) if n and spark.catalog.tableExists(t)}


def ingest_all(spark: SparkSession, landings, database: str, sheet_path: str | None = None, parallel: int = PARALLEL) -> dict[str, str]:
    """Load every landing (and the sheet) into ``database``, up to ``parallel``
    at a time, each in a scheduler pool of its own; table names. Where sets
    fail, the rest is loaded and ``IngestError`` names them."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def sheet_rows():
        name = f"{database}.terms_sheet"
        tables.full_refresh(sheet.read_sheet_csv(spark, sheet_path), name)
        return {"terms_sheet": name}

    jobs = {x.spec.name: (lambda x=x: load(spark, x, database)) for x in landings}
    if sheet_path:
        jobs["terms_sheet"] = sheet_rows

    def run(name):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        return jobs[name]()

    written, errors = {}, {}
    with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(jobs) or 1))) as pool:
        started = {name: pool.submit(inheritable_thread_target(spark)(run), name) for name in jobs}
        for name, job in started.items():
            try:
                written.update(job.result())
            except Exception as e:  # noqa: BLE001 - reported below, together
                errors[name] = e
    if errors:
        raise IngestError(errors, written)
    return written


def table_inputs(spark: SparkSession, database: str, names=INPUT_TABLES) -> Inputs:
    """The daily run's inputs from the tables of one database."""
    return Inputs({n: (lambda n=n: spark.table(f"{database}.{n}")) for n in names})
