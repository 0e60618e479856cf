"""Curated to warehouse: dimensions are upserted, the facts of the loaded dates are replaced, all or nothing.

A dimension is cut into ``BUCKETS`` by a hash of its key, a fact into dates. A load writes the buckets that hold a row it
changes, and its dates, into a version folder of its own and checks the tables as they would be. It is published by one file
in the manifest, which names for every bucket and date the version that holds it. Until that file exists readers see the old
contents, whatever was written; a rerun of the same dates gives the same contents. Buckets and dates that a load does not
change stay in the files they are in. Folders that the manifest does not name belong to replaced or failed loads.

The manifest file is named by the number of the load and created only if no other load took that number meanwhile. The loser
of two concurrent loads starts again from what the winner published, so no update is lost.
"""

import json
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from daybrook.functions import columns as C
from daybrook.operators import events as E
from daybrook.params import DEFAULTS, Params
from daybrook.plans import constraints, reports
from daybrook.schemas import USER_COLUMNS, WAREHOUSE_TYPES
from daybrook.session import materialize
from daybrook.sources import readers as R, sinks as W

DIMENSIONS = {
    "categories": ["category_id"], "users": ["user_id"], "videos": ["pid"], "video_categories": ["pid", "category_id"],
}
FACTS = {"interactions_curated": "p_date", "daily_user_features": "feature_date"}
BUCKETS, BUCKET = 32, "bucket"
ATTEMPTS = 5


class LoadError(Exception):
    """A constraint or row-count check failed; nothing was published."""


class Conflict(LoadError):
    """Another load was published first; nothing of this one was."""


def narrow(df: DataFrame, table: str) -> DataFrame:
    """Warehouse column types; ANSI casts raise on overflow."""
    types = WAREHOUSE_TYPES.get(table, {})
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def with_derived_defaults(users: DataFrame) -> DataFrame:
    """Columns the warehouse derives itself start at their defaults."""
    return users.withColumn("total_events", F.lit(0)).withColumn("is_sparse_history", F.lit(False))


MANIFEST = "load_number bigint, table_name string, part string, version string, n_rows bigint"


def _version(root, name, version):
    return f"{root}/versions/{version}/{name}"


def _bucket(name):
    return F.pmod(F.xxhash64(*DIMENSIONS[name]), F.lit(BUCKETS)).cast("int")


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """The version that holds each bucket of a dimension (its number) and each date of a fact (its label)."""
    try:
        rows = spark.read.schema(MANIFEST).json(f"{root}/manifest")
    except AnalysisException as exc:
        if not R.path_missing(exc):
            raise
        rows = spark.createDataFrame([], MANIFEST)
    last = rows.groupBy("table_name", "part").agg(F.max_by(F.struct("load_number", "version", "n_rows"), "load_number").alias("l"))
    return last.select("table_name", "part", "l.*")


def _held(state) -> dict:
    """table -> part -> (version, rows); a part without rows has no files worth opening."""
    held = {}
    for r in state:
        held.setdefault(r["table_name"], {})[r["part"]] = (r["version"], r["n_rows"])
    return held


def _table(spark, root, name, parts, leave_out=()) -> DataFrame | None:
    """Rows of a table: of every version the buckets or dates it holds. None before the first row."""
    column = FACTS.get(name, BUCKET)
    by_version = {}
    for part, (version, n) in parts.items():
        if n and part not in leave_out:
            by_version.setdefault(version, []).append(part)
    found = []
    for version, held in sorted(by_version.items()):
        values = [F.lit(C.iso_date(p)).cast("date") if name in FACTS else F.lit(int(p)) for p in held]
        rows = spark.read.parquet(_version(root, name, version)).where(F.col(column).isin(values))
        found.append(rows if name in FACTS else rows.drop(BUCKET))
    return reduce(DataFrame.unionByName, found) if found else None


def tables(spark: SparkSession, root: str) -> dict:
    """The published tables; a table that no load has filled is absent."""
    held = _held(manifest(spark, root).collect())  # one row per bucket of a dimension and per date of a fact
    found = {name: _table(spark, root, name, parts) for name, parts in held.items()}
    return {name: df for name, df in found.items() if df is not None}


def _merged(spark, name, source: DataFrame, old: DataFrame | None) -> DataFrame:
    """A dimension after the upsert; the columns that the warehouse derives keep their values."""
    source = narrow(source, name)
    full = with_derived_defaults(source) if name == "users" else source
    target = old if old is not None else spark.createDataFrame([], full.schema)
    merged = W.upsert(target, source, USER_COLUMNS if name == "users" else source.columns, DIMENSIONS[name])
    return merged.fillna({"total_events": 0, "is_sparse_history": False}) if name == "users" else merged


def _changed_buckets(name, rows: DataFrame, old: DataFrame | None) -> list[int]:
    """Buckets that hold a new or a changed row: at most ``BUCKETS`` numbers."""
    if old is not None:
        key = DIMENSIONS[name]
        was = old.select(*[F.col(c).alias(f"was_{c}") for c in rows.columns], F.lit(True).alias("was"))
        on = reduce(lambda x, y: x & y, [F.col(c) == F.col(f"was_{c}") for c in key])
        same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"was_{c}")) for c in rows.columns if c not in key], F.lit(True))
        rows = rows.join(was, on, "left").where(F.col("was").isNull() | ~same)
    return sorted(r[0] for r in rows.select(_bucket(name).alias(BUCKET)).distinct().collect())


def _counts(df: DataFrame, part) -> dict:
    return {str(k): n for k, n in df.groupBy(part.alias("part")).count().collect()}  # one row per date or bucket


def _write_facts(spark, root, version, curated, labels) -> dict:
    """Write the dates of both facts. Returns table -> label -> rows; raises if they differ from what was asked for."""
    days, counts = [F.lit(C.iso_date(d)).cast("date") for d in labels], {}
    for name, column in FACTS.items():
        wanted = curated[name].where(F.col(column).isin(days))
        rows, path = narrow(wanted, name), _version(root, name, version)
        W.replace_all(rows, path, column)
        written = spark.read.schema(rows.schema).parquet(path)
        expected, counts[name] = (_counts(df, C.date_to_label(column)) for df in (wanted, written))
        if expected != counts[name]:
            raise LoadError(f"row counts differ in {name}: written {counts[name]}, expected {expected}")
    return counts


def _write_dimension(spark, root, version, name, rows: DataFrame, old: DataFrame | None) -> dict:
    """Write the changed buckets of a dimension. Returns bucket -> rows."""
    rows = materialize(rows, name)
    buckets = _changed_buckets(name, rows, old)
    path = _version(root, name, version)
    W.replace_all(rows.withColumn(BUCKET, _bucket(name)).where(F.col(BUCKET).isin(buckets)), path, BUCKET)
    return _counts(spark.read.parquet(path), F.col(BUCKET)) if buckets else {}


def _user_totals(fresh: DataFrame, before: DataFrame | None, old_users: DataFrame | None) -> DataFrame:
    """(user_id, total_events) over all dates, from the published totals and the loaded dates alone."""
    changes = [fresh.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))]
    if before is not None:
        changes.append(before.groupBy("user_id").agg((-F.count(F.lit(1))).alias("n")))
    if old_users is not None:
        changes.append(old_users.select("user_id", F.col("total_events").cast("bigint").alias("n")))
    return reduce(DataFrame.unionByName, changes).groupBy("user_id").agg(F.sum("n").alias("total_events"))


def _load_once(spark: SparkSession, curated: dict, root: str, labels, params: Params) -> dict:
    state = manifest(spark, root).collect()
    held, number = _held(state), 1 + max((r["load_number"] for r in state), default=0)
    old = {name: _table(spark, root, name, parts) for name, parts in held.items()}
    version = uuid.uuid4().hex
    counts = _write_facts(spark, root, version, curated, labels)
    after = {name: {**held.get(name, {}), **{d: (version, counts[name].get(d, 0)) for d in labels}} for name in FACTS}

    events = "interactions_curated"
    loaded = {p: v for p, v in after[events].items() if p in labels}
    replaced = {p: v for p, v in held.get(events, {}).items() if p in labels}
    empty = narrow(curated[events], events).where("false")
    fresh, before = _table(spark, root, events, loaded), _table(spark, root, events, replaced)
    fresh = empty if fresh is None else fresh
    totals = _user_totals(fresh, before, old.get("users"))
    for name in DIMENSIONS:
        rows = _merged(spark, name, curated[name], old.get(name))
        if name == "users":
            rows = reports.sparse_flags(rows, None, params, totals)
        counts[name] = _write_dimension(spark, root, version, name, rows, old.get(name))
        after[name] = {**held.get(name, {}), **{b: (version, n) for b, n in counts[name].items()}}

    new = {name: _table(spark, root, name, parts) for name, parts in after.items()}
    for name in (*DIMENSIONS, *FACTS):
        if new.get(name) is None:
            rows = narrow(curated[name], name).where("false")
            new[name] = with_derived_defaults(rows) if name == "users" else rows
    checked = {**new, **{name: _table(spark, root, name, {p: v for p, v in after[name].items() if p in labels})
                         for name in FACTS}}
    bad = constraints.constraint_violations({n: new[n].where("false") if df is None else df for n, df in checked.items()}).where(
        "violations > 0").collect()  # one row per constraint
    # an event key may not exist under another date either
    others = _table(spark, root, events, held.get(events, {}), labels)
    clash = 0 if others is None else fresh.count() - E.not_owned_earlier(fresh, others).count()
    if bad or clash:
        names = [f"{r['table_name']}.{r['name']} ({r['violations']})" for r in bad]
        raise LoadError("constraints violated: " + ", ".join(names + ([f"event key in another date ({clash})"] if clash else [])))

    lines = [{"load_number": number, "table_name": name, "part": part, "version": version, "n_rows": n}
             for name in DIMENSIONS for part, n in counts[name].items()]
    lines += [{"load_number": number, "table_name": name, "part": d, "version": version, "n_rows": counts[name].get(d, 0)}
              for name in FACTS for d in labels]
    # the switch: one file appears, or none
    if not W.publish_once(spark, f"{root}/manifest/{number:012d}.json", "\n".join(map(json.dumps, lines))):
        raise Conflict(f"load {number} was published by another job")
    return {name: sum(n for _, n in after[name].values()) for name in DIMENSIONS} | {
        name: sum(counts[name].values()) for name in FACTS}


def load_dates(spark: SparkSession, curated: dict, root: str, dates, params: Params = DEFAULTS) -> dict:
    """Publish dates together. Returns rows per table; raises ``LoadError``, with nothing published, if a check fails.

    A load that another one overtakes is done again on the new contents, ``ATTEMPTS`` times at most.
    """
    labels = sorted({C.check_p_date(d) for d in dates})
    for attempt in range(1, ATTEMPTS + 1):
        try:
            return _load_once(spark, curated, root, labels, params)
        except Conflict:
            if attempt == ATTEMPTS:
                raise


def load_date(spark: SparkSession, curated: dict, root: str, p_date: str, params: Params = DEFAULTS) -> dict:
    """Publish one date."""
    return load_dates(spark, curated, root, [p_date], params)
