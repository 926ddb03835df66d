"""Full and delta exports with their manifests, and the state between runs.

The output folder may be in any file system that Spark can open and all executors
reach.  Rows are written by Spark, in order, into one gzip file or, beyond
``SINGLE_ROWS`` rows, into a folder of ordered part files that all tasks write.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.config import ResolverOptions
from kinfold.operators import delta as D
from kinfold.operators.components import discard, saved
from kinfold.sources.files import Files

#: Rows of an export that one task still writes into one file.
SINGLE_ROWS = 1_000_000
STATE_VERSION = 1
STATE_SCHEMA = "resource_id string, golden_hash string"


def now_iso() -> str:
    return datetime.now(timezone.utc).isoformat()


def export_name(provider: str, kind: str, at: datetime) -> str:
    """File name of an export of the hour; whatever follows a last dot in it is cut off."""
    stem = f"{provider}_{at.strftime('%Y-%m-%dT%H')}_{kind}"
    return stem.rsplit(".", 1)[0] + ".jsonl.gz"


def file_sha256(path: Path, chunk: int = 1 << 20) -> str:
    """sha256 of a file, or of the part files of a folder one after the other."""
    digest = hashlib.sha256()
    parts = sorted(p for p in path.iterdir() if p.name.startswith("part-")) if path.is_dir() else [path]
    for part in parts:
        with part.open("rb") as f:
            while block := f.read(chunk):
                digest.update(block)
    return digest.hexdigest()


def write_lines(rows: DataFrame, order: list[str], files: Files, name: str, single: bool) -> None:
    """The column ``json`` of ``rows``, in order, as gzipped lines at ``name``."""
    work = f".{name}.{uuid.uuid4().hex}"
    lines = rows.select(*order, "json")
    ordered = lines.repartition(1).sortWithinPartitions(*order) if single else lines.orderBy(*order)
    ordered.select("json").write.option("compression", "gzip").text(files.at(work))
    if single:
        files.move(f"{work}/{next(p for p in files.names(work) if p.startswith('part-'))}", name)
        files.delete(work)
    else:
        files.move(work, name)


def _write_json(files: Files, name: str, body: dict) -> None:
    files.write(name, json.dumps(body, indent=2, ensure_ascii=False))


def load_state(spark: SparkSession, files: Files, name: str) -> tuple[dict, DataFrame]:
    """(version and provider, hashes); a missing or unreadable state is empty."""
    empty = spark.createDataFrame([], STATE_SCHEMA)
    head = {"version": STATE_VERSION, "provider": None}
    if not files.exists(name):
        return head, empty
    try:
        meta = json.loads(files.read(name))
    except ValueError:
        return head, empty
    if not isinstance(meta, dict):
        return head, empty
    head = {k: meta.get(k, v) for k, v in head.items()}
    table, hashes = meta.get("golden_hashes_table"), meta.get("golden_hashes")
    if table:
        return head, spark.read.schema(STATE_SCHEMA).parquet(files.at(table)) if files.exists(table) else empty
    if isinstance(hashes, dict) and hashes:
        return head, spark.createDataFrame([(k, str(v)) for k, v in hashes.items()], STATE_SCHEMA)
    return head, empty


def save_state(state: DataFrame, files: Files, name: str, provider: str, collisions: int) -> int:
    """Write the hashes as a table beside the state file, then swap the state file to it."""
    stem = f"{name.rsplit('.', 1)[0]}_hashes_"
    table = f"{stem}{datetime.now(timezone.utc).strftime('%Y%m%d%H%M%S%f')}"
    state.write.parquet(files.at(table))
    n = state.sparkSession.read.schema(STATE_SCHEMA).parquet(files.at(table)).count()
    _write_json(files, name, {"version": STATE_VERSION, "provider": provider, "exported_at_iso": now_iso(), "records": n, "collisions": collisions, "golden_hashes_table": table})
    for old in files.names():
        if old.startswith(stem) and old != table:
            files.delete(old)
    return n


def datasets_of(golden: DataFrame) -> list[str]:
    """Sorted dataset names of all rows."""
    return [r[0] for r in golden.select(F.explode("datasets").alias("d")).distinct().orderBy("d").collect()]


def export(golden: DataFrame, out: str | Path, options: ResolverOptions, single: bool | None = None) -> dict:
    """Write FULL and, if enabled, DELTA with manifests, then the state; returns both manifests.

    ``golden`` has seq columns (component, sub_no), json, golden_hash, resource_id, datasets.
    ``single`` asks for one file or for part files; as a default the number of rows decides.
    """
    spark = golden.sparkSession
    files = Files(spark, out)
    files.make()
    at = datetime.now(timezone.utc)
    order = ["component", "sub_no"]
    golden = golden.withColumn("seq", F.struct(*order))
    records = golden.count()
    single = records <= SINGLE_ROWS if single is None else single
    full = export_name(options.provider, "FULL", at)
    write_lines(golden, order, files, full, single)
    crashes = D.collisions(golden)
    count = crashes.count()
    datasets = datasets_of(golden)
    hashing = {"algorithm": "sha256", "excluded_data_fields": list(options.excluded_data_fields)}
    meta = {
        "sha256": files.sha256(full),
        "file": full,
        "format": "jsonl.gz",
        "records": records,
        "exported_at_iso": now_iso(),
        "datasets": datasets,
        "source_dir": options.source_dir,
        "max_block_size": options.max_block_size,
        "hashing": hashing,
        "collisions": {"count": count, "sample_ids": [r[0] for r in crashes.orderBy("seq").limit(10).select("resource_id").collect()]},
    }
    _write_json(files, f"{options.provider}_meta.json", meta)
    if not options.enable_delta:
        return {"full": meta, "delta": None}

    _, previous = load_state(spark, files, options.state_file)
    changed = saved(D.classify(golden, previous).where("change <> 'SAME'").select(*order, "json", "change"))
    counts = {r["change"]: r["n"] for r in changed.groupBy("change").agg(F.count("*").alias("n")).collect()}
    part = export_name(options.provider, "DELTA", at)
    write_lines(changed, order, files, part, single)
    discard(changed)
    delta = {
        "sha256": files.sha256(part),
        "file": part,
        "format": "jsonl.gz",
        "records": sum(counts.values()),
        "new_records": counts.get("NEW", 0),
        "updated_records": counts.get("UPDATED", 0),
        "exported_at_iso": now_iso(),
        "datasets": datasets,  # of all golden rows, not of the changed ones
        "state_file": options.state_file,
        "full_file": full,
        "hashing": hashing | {"note": "Hash of the merged record without the excluded fields; another hash means UPDATED."},
    }
    _write_json(files, f"{options.provider}_delta_meta.json", delta)
    save_state(D.current_state(golden), files, options.state_file, options.provider, count)
    return {"full": meta, "delta": delta}
