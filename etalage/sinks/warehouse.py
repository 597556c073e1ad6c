"""Warehouse tables as Parquet, with an append-only journal of loads.

Each load writes to a folder of its own, in one or more pieces; the journal row appended afterwards makes them
current and names the pieces that they replace.  What a table holds follows from these lists alone, not from
any clock: a load that ended while another was rewriting the table is in nobody's list and stays.  A rewrite whose
pieces are no longer all current when it ends is done again; a failed or repeated task never damages what
readers see, and a table can be rewritten from itself.
"""

from __future__ import annotations

import datetime as dt
import functools
import operator
import uuid
import zlib
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F

from etalage import contracts as K
from etalage.operators.rows import keep_last, union_aligned
from etalage.storage import COMPRESSION, delete, materialise

# Load states, strategies and the tables of the two zones.
DONE = "succès"
FAILED = "échec"
SKIPPED = "ignoré (DataFrame vide)"
REPLACE, APPEND, UPSERT = "replace", "append", "upsert"
STAGING_TABLES = ["clients", "transactions", "produits", "magasins"]
MART_TABLES = ["ca_mensuel", "top_produits", "performance_magasins", "segmentation_rfm",
               "mart_ventes", "mart_clients", "mart_produits"]

BUCKETS = 64
ATTEMPTS = 3
ROWS_PER_PART = 1_000_000
_BUCKET, _NEW, _PLACE, _REPLACED = "__seau", "__nouveau", "__place", "__remplace"


class ConcurrentLoad(RuntimeError):
    """A table was rewritten by others each time this load tried to."""


@dataclass(frozen=True)
class Piece:
    """A folder of a table with its rows, written and not yet in the journal: no reader of the table sees it."""

    location: str
    rows: int


def write_piece(df: DataFrame, root: str, table: str) -> Piece:
    """The first half of a load, for a table that others are made from before it is loaded: ``load_table`` takes the piece
    and does the second.  A piece that no load takes stays for ``vacuum``, or for ``drop_pieces``.
    """
    location = _new_folder(root, table)
    try:
        df.write.parquet(location, compression=COMPRESSION)
        return Piece(location, df.sparkSession.read.parquet(location).count())  # reads file footers only
    except Exception:
        delete(df.sparkSession, location)
        raise


def drop_pieces(spark: SparkSession, root: str, pieces: Mapping[str, str]) -> None:
    """Delete those pieces (locations by ``zone.name``) that are not current in their table."""
    for table, location in pieces.items():
        if location not in current_pieces(spark, root, table):
            delete(spark, location)


def load_table(df: DataFrame, root: str, table: str, strategy: str = REPLACE, keys: Sequence[str] = (),
               order_by: Sequence[str] = (), run_id: str = "", rejected: int = 0, buckets: int = BUCKETS,
               piece: Piece | None = None) -> DataFrame:
    """Write ``df`` into ``table`` (``zone.name``), append its journal row and return that row.

    ``replace`` and ``append`` do what they say; ``upsert`` replaces rows with equal ``keys`` and adds the
    others, the last of several updates (by ``order_by``) winning.  An upserted table is kept in ``buckets``
    pieces by a hash of its keys, and only pieces that hold keys of the updates are rewritten.  Source rows are
    counted as they are written.  An empty source changes nothing.  ``rejected`` is what the caller left out.
    ``piece``: where ``write_piece`` has written ``df`` already, for a replace or an append; it is not written again.
    """
    if strategy not in (REPLACE, APPEND, UPSERT):
        raise ValueError(f"unknown strategy: {strategy}")
    if strategy == UPSERT and piece is not None:
        raise ValueError("an upsert takes no piece")
    spark, started = df.sparkSession, now()
    entry = {"table_cible": table, "strategie": strategy, "debut_chargement": started, "pipeline_run_id": run_id,
             "statut": FAILED, "nb_lignes_source": 0, "nb_lignes_inserees": 0, "nb_lignes_mises_a_jour": 0,
             "nb_lignes_rejetees": rejected, "erreur": None, "emplacement": None, "morceaux": [], "remplace": []}
    location = _new_folder(root, table)
    source = Observation()
    observed = df.observe(source, F.count(F.lit(1)).alias("n"))
    try:
        if strategy == UPSERT:
            updates = materialise(keep_last(observed, list(keys), list(order_by)), "updates")
            # a source that Spark knows to be empty is not observed
            n = 0 if updates.isEmpty() else source.get["n"]
            if n:
                entry |= _upsert_until_current(spark, updates, root, table, list(keys), buckets)
        else:
            before = current_pieces(spark, root, table) if strategy == REPLACE else []
            if piece is None:
                observed.write.parquet(location, compression=COMPRESSION)
                n = source.get["n"]
            else:
                n = piece.rows
            if n:
                held = location if piece is None else piece.location
                entry |= {"nb_lignes_inserees": n, "emplacement": held, "morceaux": [held], "remplace": before}
            else:
                delete(spark, location)
        entry["nb_lignes_source"] = n
        entry["statut"] = DONE if n else SKIPPED
    except Exception as error:  # journaled, then raised as it came
        delete(spark, location)
        entry["erreur"] = str(error)
        _append_journal(spark, root, entry)
        raise
    return _append_journal(spark, root, entry)


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows without an update, then the updates.  ``updates`` holds each key once.

    Rows that carry the place where they are written, the same one for all rows of a key, are dealt out by it, once.
    """
    if _PLACE not in updates.columns:
        kept = target.join(updates.select(*keys), list(keys), "left_anti")
        return kept.unionByName(updates, allowMissingColumns=True)
    both = target.withColumn(_NEW, F.lit(False)).unionByName(updates.withColumn(_NEW, F.lit(True)), allowMissingColumns=True)
    replaced = F.max(_NEW).over(Window.partitionBy(_PLACE, *keys))
    keyless = functools.reduce(operator.or_, [F.col(k).isNull() for k in keys])  # replaces nothing and is not replaced
    kept = both.repartition(_PLACE).withColumn(_REPLACED, replaced).where(F.col(_NEW) | ~F.col(_REPLACED) | keyless)
    return kept.drop(_NEW, _REPLACED)


def merged(target: DataFrame, updates: DataFrame, keys: Sequence[str], by: Sequence[str], rows: int,
           merge: Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame] | None = None) -> DataFrame:
    """The same rows as ``upsert``, dealt out once by the columns ``by`` of the place where they are written.

    A join would deal the target out by its keys and the writer all rows again.  ``rows`` is the size of the largest
    place: beyond ``ROWS_PER_PART`` its rows go to several tasks, all those of a key to the same one.
    """
    parts = -(-rows // ROWS_PER_PART) or 1
    part = F.pmod(F.shiftright(F.xxhash64(*[F.col(k).cast("string") for k in keys]), 20), F.lit(parts))
    place = F.struct(*by, part.alias("part"))
    return (merge or upsert)(target.withColumn(_PLACE, place), updates.withColumn(_PLACE, place), keys).drop(_PLACE)


def _upsert_until_current(spark: SparkSession, updates: DataFrame, root: str, table: str, keys: list[str],
                          buckets: int) -> dict:
    for _ in range(ATTEMPTS):
        done = _write_upsert(spark, updates, root, table, keys, buckets)
        if set(done["remplace"]) <= set(current_pieces(spark, root, table)):
            return done
        delete(spark, done["emplacement"])
    raise ConcurrentLoad(table)


def _write_upsert(spark: SparkSession, updates: DataFrame, root: str, table: str, keys: list[str],
                  buckets: int) -> dict:
    """Rewrite the pieces that hold keys of ``updates``, and all pieces that are not in buckets of these keys."""
    scheme = f"seaux-{zlib.crc32('|'.join([*keys, str(buckets)]).encode()):08x}"
    bucket = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")
    pieces = current_pieces(spark, root, table)
    kept_in_buckets = {p for p in pieces if f"-{scheme}/{_BUCKET}=" in p}
    loose = [p for p in pieces if p not in kept_in_buckets]

    def numbers(df: DataFrame) -> set[int]:  # at most ``buckets`` of them
        return {r[0] for r in df.select(bucket.alias("b")).distinct().collect()}

    touched = numbers(updates)
    if loose:
        touched |= numbers(spark.read.parquet(*loose))
    old = loose + sorted(p for p in kept_in_buckets if int(p.rpartition("=")[2]) in touched)
    location = _new_folder(root, table, scheme)
    # these counts read file footers only
    target = spark.read.parquet(*old) if old else None
    before, changed = target.count() if target is not None else 0, updates.count()
    if target is None:
        rows = updates.withColumn(_BUCKET, bucket).hint("rebalance", _BUCKET)
    else:
        largest = (before + changed) // len(touched)  # buckets of a hash are about equal
        rows = merged(target.withColumn(_BUCKET, bucket), updates.withColumn(_BUCKET, bucket), keys, [_BUCKET], largest)
    rows.write.partitionBy(_BUCKET).parquet(location)
    new = [f"{location}/{_BUCKET}={b}" for b in sorted(touched)]
    after = spark.read.parquet(*new).count()
    replaced = before - (after - changed)
    return {"nb_lignes_inserees": changed - replaced, "nb_lignes_mises_a_jour": replaced, "emplacement": location,
            "morceaux": new, "remplace": old}


def current_pieces(spark: SparkSession, root: str, table: str) -> list[str]:
    """The pieces a table consists of now.

    Loads are taken in the order of their journal rows; a rewrite counts only if all pieces that it was made
    from are still there, so of two rewrites of the same pieces all readers see the same one.  The list is as
    long as the loads since the last rewrite and the number of buckets.
    """
    journal = _journal_rows(spark, root)  # rows that stand in it twice change nothing here
    if journal is None:
        return []
    done = journal.where((F.col("table_cible") == table) & (F.col("statut") == DONE))
    loads = done.select("fin_chargement", "emplacement", "strategie", "morceaux", "remplace").collect()
    current: dict[str, None] = {}
    for load in sorted(loads, key=lambda r: (r["fin_chargement"], r["emplacement"])):
        if load["strategie"] == UPSERT and not set(load["remplace"]) <= current.keys():
            continue
        for piece in load["remplace"]:
            current.pop(piece, None)
        current |= dict.fromkeys(load["morceaux"])
    return list(current)


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """What the table holds now; None before its first load."""
    pieces = current_pieces(spark, root, table)
    return spark.read.parquet(*pieces) if pieces else None


def compact(spark: SparkSession, root: str, table: str, run_id: str = "") -> DataFrame | None:
    """Write the pieces of a table that was appended to often as one; its journal row, or None without a table."""
    now = read_table(spark, root, table)
    return None if now is None else load_table(now, root, table, REPLACE, run_id=run_id)


def vacuum(spark: SparkSession, root: str, table: str, before: dt.datetime) -> list[str]:
    """Delete folders and pieces of a table that are not current and were last written before ``before`` (UTC).

    Choose a time that no running load or reader goes back to.  Returns what was deleted.
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{root}/{table.replace('.', '/')}")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    current = {p.partition("/run=")[2] for p in current_pieces(spark, root, table)}
    limit = before.replace(tzinfo=dt.timezone.utc).timestamp() * 1000
    gone = []
    for load in files.listStatus(folder):
        name = load.getPath().getName().removeprefix("run=")
        if load.getModificationTime() >= limit or name in current:
            continue
        inside = {p for p in current if p.startswith(f"{name}/")}
        if not inside:
            gone.append(load.getPath())
            continue
        gone += [piece.getPath() for piece in files.listStatus(load.getPath())
                 if piece.isDirectory() and f"{name}/{piece.getPath().getName()}" not in inside]
    for path in gone:
        files.delete(path, True)
    return [path.toString() for path in gone]


def _new_folder(root: str, table: str, scheme: str = "") -> str:
    return f"{root}/{table.replace('.', '/')}/run={uuid.uuid4().hex}{f'-{scheme}' if scheme else ''}"


def read_journal(spark: SparkSession, root: str) -> DataFrame | None:
    """One row per load, or None before the first one."""
    rows = _journal_rows(spark, root)
    return None if rows is None else rows.distinct()


def compact_journal(spark: SparkSession, root: str) -> int:
    """Join the files of the journal, one per load, into one; the number of files joined.

    The joined file is in place before the others go, and readers take equal rows once, so a run that is cut short
    loses and counts nothing twice.  Rows appended meanwhile stay.  A reader at work may have to start again.
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(_journal_path(root))
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return 0
    old = [f.getPath() for f in files.listStatus(folder) if f.isFile() and not f.getPath().getName().startswith(("_", "."))]
    if len(old) < 2:
        return 0
    aside = jvm.org.apache.hadoop.fs.Path(folder, f"_compact-{uuid.uuid4().hex}")
    joined = spark.read.schema(K.JOURNAL).parquet(*[f.toString() for f in old]).distinct()
    joined.coalesce(1).write.parquet(aside.toString())
    new = [f.getPath() for f in files.listStatus(aside) if f.getPath().getName().startswith("part-")]
    for path in new:
        if not files.rename(path, jvm.org.apache.hadoop.fs.Path(folder, path.getName())):
            raise OSError(f"cannot move {path.toString()}")
    for path in [*old, aside]:
        files.delete(path, True)
    return len(old)


def _journal_rows(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(K.JOURNAL).parquet(_journal_path(root))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def table_of(name: str) -> str | None:
    """The table that a frame of this name is loaded into, None if it is in no zone."""
    return f"staging.{name}" if name in STAGING_TABLES else f"marts.{name}" if name in MART_TABLES else None


def staging_loads(frames: Mapping[str, DataFrame], root: str, run_id: str, rejected: Mapping[str, int] | None = None,
                  pieces: Mapping[str, Piece] | None = None) -> list[DataFrame]:
    """Replace the staging tables that are given; ``pieces`` are those of them that are written."""
    return [load_table(frames[name], root, table_of(name), run_id=run_id, rejected=(rejected or {}).get(name, 0),
                       piece=(pieces or {}).get(name)) for name in STAGING_TABLES if name in frames]


def mart_loads(frames: Mapping[str, DataFrame], root: str, run_id: str,
               pieces: Mapping[str, Piece] | None = None) -> list[DataFrame]:
    """Replace the mart tables that are given; ``pieces`` are those of them that are written."""
    return [load_table(frames[name], root, table_of(name), run_id=run_id, piece=(pieces or {}).get(name))
            for name in MART_TABLES if name in frames]


def load_all(staging: Mapping[str, DataFrame], marts: Mapping[str, DataFrame], root: str, run_id: str,
             rejected: Mapping[str, int] | None = None,
             pieces: Mapping[str, Piece] | None = None) -> tuple[bool, DataFrame | None]:
    """Load staging, then marts: (no load failed, journal rows of this run).  ``rejected`` counts rows per table."""
    rows = staging_loads(staging, root, run_id, rejected, pieces) + mart_loads(marts, root, run_id, pieces)
    if not rows:
        return True, None
    spark = rows[0].sparkSession
    report = read_journal(spark, root).where(F.col("pipeline_run_id") == run_id)
    return report.where(F.col("statut") == FAILED).isEmpty(), report


def load_report(journal: DataFrame) -> DataFrame:
    """Loads and rows per status."""
    return journal.groupBy("statut").agg(F.count(F.lit(1)).alias("nb_chargements"),
                                         F.sum("nb_lignes_inserees").alias("nb_lignes_inserees"))


def stage_counts(stage: str, frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each table of a stage, as rows for ``pipeline_summary``; one pass per table."""
    counts = [df.agg(F.count(F.lit(1)).alias("nb_lignes")).select(
        F.lit(stage).alias("etape"), F.lit(name).alias("nom_table"), "nb_lignes",
        F.lit(None).cast("string").alias("statut")) for name, df in frames.items()]
    return union_aligned(*counts)


def pipeline_summary(journal: DataFrame, *stages: DataFrame) -> DataFrame:
    """Rows per zone and table in the latest load of each table, after those of earlier stages."""
    latest = Window.partitionBy("table_cible").orderBy(F.desc("fin_chargement"))
    zone = F.split("table_cible", r"\.")
    loads = (journal.withColumn("rn", F.row_number().over(latest)).where("rn = 1")
                    .select(F.get(zone, F.lit(0)).alias("etape"), F.get(zone, F.lit(1)).alias("nom_table"),
                           F.col("nb_lignes_inserees").alias("nb_lignes"), "statut"))
    return union_aligned(*stages, loads)


def _append_journal(spark: SparkSession, root: str, entry: dict) -> DataFrame:
    finished = now()
    elapsed = Decimal(str(round((finished - entry["debut_chargement"]).total_seconds(), 2)))
    entry = {**entry, "fin_chargement": finished, "duree_secondes": elapsed, "date_execution": finished.date()}
    row = spark.createDataFrame([tuple(entry[f.name] for f in K.JOURNAL)], K.JOURNAL)
    row.coalesce(1).write.mode("append").parquet(_journal_path(root))
    return row


def _journal_path(root: str) -> str:
    return f"{root}/staging/journal_chargements"


def now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
