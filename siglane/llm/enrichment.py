"""Valid-time enrichment: a stateful stream gives every sale the version of its client that was valid when it was sold.

Sales and client changes are cut into batches by their day of arrival and fed in order to one streaming query, which is
started anew for each batch on one checkpoint. Its state is made of segments. A segment is a version of a client and owns the waiting sales of its validity span; a base segment owns those before a client's first version. A new
version splits the segment it falls into, the horizon H drains the sales that it has passed, and pruning deletes the
versions before a client's last one up to H, whose segments H has emptied.

Clients are dealt to buckets, the stream's grouping key, whose number follows the number of rows. The state of a bucket
packs the segments of its clients, so that a start reads and writes one value for each bucket. The stores are Spark's
plain ones, which hold a partition's buckets in the executor's heap while its task runs and are unloaded afterwards. A
RocksDB store leaves native memory behind each time one is opened, and each start opens one in every partition. A client with more than 1 / HOT_SHARE of all rows is cut into time slices of about equal numbers of rows, each a
unit of its own with its own segments. What a slice has to know of the others comes as a control row with each batch:
the last unpruned version before it, how many versions the client holds, and whether a version up to H in a later slice
has pruned all of its own. These rows come from sums over (client, slice, batch) and are bounded by
HOT_SHARE * SLICES a batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from siglane.llm import common
from siglane.llm.common import HOT_SHARE, prepare, shared_dir
from siglane.session import file_system

#: Time slices of a hot client.
SLICES = 128
#: Rows of all batches that a bucket gets on average, and the fewest buckets there are.
BUCKET_ROWS, LEAST_BUCKETS = 1 << 16, 192
#: Stands for no time: the base segment, a sale without a time.
NEVER = -(1 << 63)
SALE, CHANGE, CONTROL, TICK = range(4)
CLIENT, ID, CENTS, CARRY, CLEAR = 1, 2, 4, 8, 16
EVENT = "kind byte, bucket int, client long, slice int, id long, at long, cents long, op string, flags int, held long"
RESULT = "rec string, id long, batch long, n_held long, change_id long, balance_cents long, op string"
#: Settings of the stream while it runs: each start opens stores of its own, which else keep their memory for a while.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


@dataclass(frozen=True)
class Plan:
    """Batches by the day of arrival, and how far a watermark stays behind the largest time of earlier batches."""

    first_day: int = 19723
    days: int = 152
    batches: int = 10
    lag_micros: int = 24 * 3600 * 1_000_000
    #: Days that a change takes to arrive: crc32 of its id modulo this.
    delays: int = 4


def _day(at: Column) -> Column:
    return F.datediff(at.cast("date"), F.lit("1970-01-01").cast("date"))


def _micros(at: Column) -> Column:
    clock = (F.hour(at) * 3600 + F.minute(at) * 60).cast("long") * 1_000_000
    return _day(at).cast("long") * 86_400_000_000 + clock + (F.extract(F.lit("SECOND"), at) * 1_000_000).cast("long")


def _batch(day: Column, plan: Plan) -> Column:
    """The batch of a day; days before the first are in batch 0, unknown ones in the last."""
    last = F.lit(plan.batches - 1).cast("long")
    return F.greatest(F.lit(0).cast("long"), F.least(last, F.floor((day - plan.first_day) * plan.batches / plan.days))).cast("int")


def _flag(there: Column, flag: int) -> Column:
    return F.when(there.isNotNull(), flag).otherwise(0)


def _sales(sales: DataFrame, plan: Plan) -> DataFrame:
    s = sales.select(F.col("sale_id").cast("long").alias("id"), F.col("client_id").cast("long").alias("client"), _micros(F.col("sold_at")).alias("at"), _batch(_day(F.col("arrived_at")), plan).alias("batch"))
    return s.select(F.lit(SALE).cast("byte").alias("kind"), "client", "id", "at", F.lit(None).cast("long").alias("cents"), F.lit(None).cast("string").alias("op"), "batch")


def _changes(changes: DataFrame, plan: Plan) -> DataFrame:
    names = ("change_id", "client_id", "seq", "op", "valid_at", "source", "segment", "city", "balance")
    c = changes.select(*names).filter("valid_at is not null").distinct()
    delay = F.pmod(F.crc32(F.coalesce(F.col("change_id").cast("string"), F.lit("")).cast("binary")), F.lit(plan.delays))
    cents = F.when(F.isnan(F.col("balance").cast("double")) | (F.abs("balance") > 9e16), None).otherwise(F.floor(100 * F.col("balance") + 0.5))
    c = c.select(F.col("change_id").cast("long").alias("id"), F.col("client_id").cast("long").alias("client"), _micros(F.col("valid_at")).alias("at"), cents.alias("cents"), "op", _batch(_day(F.col("valid_at")) + delay, plan).alias("batch"))
    return c.select(F.lit(CHANGE).cast("byte").alias("kind"), "client", "id", "at", "cents", "op", "batch")


def _hot(rows: DataFrame, total: int) -> tuple[list[int], DataFrame]:
    """(clients with more than total / HOT_SHARE rows, fewer than HOT_SHARE; client, bounds of each)."""
    counts = rows.filter("client is not null").groupBy("client").agg(F.count("*").alias("n"))
    own = [r["client"] for r in counts.filter(F.col("n") * HOT_SHARE > total).select("client").collect()]
    shares = F.array(*(F.lit(k / SLICES) for k in range(1, SLICES)))
    return own, rows.filter(F.col("client").isin(own)).groupBy("client").agg(F.coalesce(F.percentile_approx("at", shares, 2000), F.array().cast("array<long>")).alias("bounds"))


def _dealt(rows: DataFrame, hot: DataFrame, buckets: int) -> DataFrame:
    """Events with their slice and bucket, nulls as flags."""
    spread = F.pmod(F.xxhash64("id"), F.lit(SLICES)).cast("int")
    rows = rows.join(F.broadcast(hot), "client", "left")
    in_time = F.size(F.filter("bounds", lambda b: b <= F.col("at")))
    # A row without a time needs no segment, one without a client none but its own.
    place = F.when(F.col("client").isNull(), spread).when(F.col("bounds").isNull(), -1).when(F.col("at").isNull(), spread).otherwise(in_time)
    flags = _flag(F.col("client"), CLIENT) + _flag(F.col("id"), ID) + _flag(F.col("cents"), CENTS)
    rows = rows.select("kind", F.coalesce("client", F.lit(0)).alias("client"), place.cast("int").alias("slice"), F.coalesce("id", F.lit(NEVER)).alias("id"), F.coalesce("at", F.lit(NEVER)).alias("at"), F.coalesce("cents", F.lit(0)).alias("cents"), "op", flags.alias("flags"), F.lit(0).cast("long").alias("held"), "batch")
    return _placed(rows, buckets)


def _placed(rows: DataFrame, buckets: int) -> DataFrame:
    unit = F.xxhash64("client", "slice")
    bucket = F.pmod(unit, F.lit(buckets)).cast("int")
    return rows.withColumn("bucket", bucket).select(*(x.split()[0] for x in EVENT.split(", ")), "batch")


def _controls(changes: DataFrame, clients: list[int], hot: DataFrame, late: list[int | None], horizon: list[int | None], plan: Plan) -> DataFrame:
    """A control row for each hot client, slice and batch; changes: dealt events of the changes."""
    own = changes.filter(F.col("client").isin(clients) & (F.col("flags").bitwiseAND(CLIENT) > 0))
    for b, before in enumerate(late[: plan.batches]):
        if before is not None:
            own = own.filter((F.col("batch") != b) | (F.col("at") >= before))
    version = F.struct("at", "id", "cents", "op", "flags", "slice")
    last = plan.batches
    by_slice = own.groupBy("client", "slice", "batch").agg(F.max(version).alias("v"))
    grid = hot.select("client", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))).alias("slice"), F.lit(0).alias("batch"))
    by_slice = by_slice.unionByName(grid.withColumn("v", F.lit(None).cast(by_slice.schema["v"].dataType)))
    by_slice = by_slice.select("client", "slice", F.explode(F.sequence(F.col("batch"), F.lit(last))).alias("batch"), "v").groupBy("client", "slice", "batch").agg(F.max("v").alias("v"))
    before = Window.partitionBy("client", "batch").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    by_slice = by_slice.select("client", "slice", "batch", F.max("v").over(before).alias("v"))
    # Of each client and batch: the last version up to the horizon of the batch before, and how many are held.
    sums = []
    for b in range(last + 1):
        h = horizon[b - 1] if b else None
        old = (F.col("batch") < b) & ((F.col("at") <= h) if h is not None else F.lit(False))
        young = (F.col("batch") == b) | (F.col("batch") < b) & ((F.col("at") > h) if h is not None else F.lit(True))
        sums += [F.max(F.when(old, version)).alias(f"p{b}"), F.count_if(young).alias(f"n{b}")]
    by_client = own.groupBy("client").agg(*sums)
    each = F.explode(F.array(*(F.struct(F.lit(b).alias("batch"), F.col(f"p{b}").alias("p"), F.col(f"n{b}").alias("n")) for b in range(last + 1))))
    by_client = by_client.select("client", each.alias("x")).select("client", "x.batch", "x.p", (F.col("x.n") + F.when(F.col("x.p").isNull(), 0).otherwise(1)).alias("n"))
    rows = by_slice.join(F.broadcast(by_client), ["client", "batch"], "left")
    carry = F.col("v").isNotNull() & (F.col("p").isNull() | (F.col("v") >= F.col("p")))
    clear = F.coalesce(F.col("p.slice") > F.col("slice"), F.lit(False))
    flags = F.when(carry, F.col("v.flags").bitwiseOR(CARRY)).otherwise(CLIENT).bitwiseOR(F.when(clear, CLEAR).otherwise(0))
    pick = lambda name, other: F.when(carry, F.col(f"v.{name}")).otherwise(F.lit(other))
    return rows.select(F.lit(CONTROL).cast("byte").alias("kind"), "client", "slice", pick("id", NEVER).alias("id"), pick("at", NEVER).alias("at"), pick("cents", 0).alias("cents"), pick("op", None).alias("op"), flags.cast("int").alias("flags"), F.coalesce("n", F.lit(0)).alias("held"), "batch")


_FIELDS = ("client", "slice", "at", "id", "cents", "flags")
_KINDS = (np.int64, np.int32, np.int64, np.int64, np.int64, np.int32)
_SALE = pa.struct([("id", pa.int64()), ("flags", pa.int32()), ("at", pa.int64())])


def _pack(segments: dict, sales: dict, owner: np.ndarray) -> bytes:
    """Segments in their order, each with the sales that it owns, as an Arrow stream."""
    order = np.argsort(owner, kind="stable")
    offsets = np.searchsorted(owner[order], np.arange(len(segments["at"]) + 1)).astype(np.int32)
    owned = pa.StructArray.from_arrays([pa.array(sales[k][order], t.type) for k, t in zip(("id", "flags", "at"), _SALE, strict=True)], fields=list(_SALE))
    columns = [pa.array(segments[k]) for k in _FIELDS] + [pa.array(segments["op"], pa.string()), pa.ListArray.from_arrays(pa.array(offsets), owned)]
    batch = pa.RecordBatch.from_arrays(columns, names=[*_FIELDS, "op", "sales"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(held: bytes | None) -> tuple[dict, dict]:
    """Segments, and their sales with the units of their owners."""
    if held is None:
        segments = {k: np.zeros(0, dtype=t) for k, t in zip(_FIELDS, _KINDS, strict=True)} | {"op": np.zeros(0, dtype=object)}
        return segments, {k: np.zeros(0, dtype=t) for k, t in (("client", np.int64), ("slice", np.int32), ("id", np.int64), ("flags", np.int32), ("at", np.int64))}
    batch = pa.ipc.open_stream(held).read_next_batch()
    segments = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in (*_FIELDS, "op")}
    lists = batch.column("sales")
    owned = lists.flatten()
    n = np.diff(lists.offsets.to_numpy())
    sales = {k: owned.field(i).to_numpy(zero_copy_only=False) for i, k in enumerate(("id", "flags", "at"))}
    return segments, sales | {k: np.repeat(segments[k], n) for k in ("client", "slice")}


def _joined(*parts: dict) -> dict:
    return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}


def _taken(x: dict, which: np.ndarray) -> dict:
    return {k: v[which] for k, v in x.items()}


def _nullable(values: np.ndarray, there: np.ndarray) -> pd.api.extensions.ExtensionArray:
    return pd.arrays.IntegerArray(np.where(there, values, 0).astype(np.int64), ~there)


def turn(held: bytes | None, rows: dict, batch: int, late_before: int | None, horizon: int | None, last: bool) -> tuple[pd.DataFrame, bytes | None]:
    """(results, the bucket's segments afterwards) of one batch's rows of a bucket. rows: arrays of the columns of EVENT."""
    segments, waiting = _unpack(held)
    kind, there = rows["kind"], (rows["flags"] & CLIENT) > 0
    late = (kind == CHANGE) & (rows["at"] < late_before) if late_before is not None else np.zeros(len(kind), dtype=bool)
    # Versions without a client are no sale's.
    new = _taken({k: rows[k] for k in (*_FIELDS, "op")}, (kind == CHANGE) & ~late & there)
    control = _taken({k: rows[k] for k in (*_FIELDS, "op", "held")}, kind == CONTROL)
    came = _taken({k: rows[k] for k in ("client", "slice", "id", "flags", "at")}, kind == SALE)
    sales = _joined(waiting, came)

    # Units: clients, slices of hot ones; those without a client apart.
    parts = [segments, new, control, sales]
    names = pd.DataFrame({"c": np.concatenate([p["client"] for p in parts]), "s": np.concatenate([p["slice"] for p in parts]), "f": np.concatenate([p["flags"] & CLIENT for p in parts[:3]] + [sales["flags"] & CLIENT])})
    unit = names.groupby(["c", "s", "f"], sort=False).ngroup().to_numpy()
    of_segment, of_new, of_control, of_sale = np.split(unit, np.cumsum([len(p["client"]) for p in parts])[:-1])
    units = int(unit.max()) + 1 if len(unit) else 0

    cleared = np.zeros(units, dtype=bool)
    cleared[of_control[(control["flags"] & CLEAR) > 0]] = True
    versions = segments["at"] != NEVER
    kept = versions & ~cleared[of_segment]
    # A base segment for each unit, which for slices of hot clients stands for the version carried into it.
    first = pd.Series(np.arange(len(unit))).groupby(unit, sort=True).first().to_numpy()
    base = {"client": names["c"].to_numpy()[first], "slice": names["s"].to_numpy()[first], "at": np.full(units, NEVER), "id": np.full(units, NEVER), "cents": np.zeros(units, dtype=np.int64), "flags": names["f"].to_numpy()[first].astype(np.int32), "op": np.full(units, None, dtype=object)}
    for k in ("id", "cents", "flags", "op"):
        base[k][of_control] = control[k]
    segments = _joined(base, _taken(segments, kept), new)
    of_segment = np.concatenate([np.arange(units), of_segment[kept], of_new])
    is_base = np.arange(len(of_segment)) < units
    order = np.lexsort((pd.Series(segments["op"]).fillna("").rank(method="dense").to_numpy(), segments["cents"], np.where(is_base, NEVER, segments["id"]), segments["at"], of_segment))
    segments, of_segment, is_base = _taken(segments, order), of_segment[order], is_base[order]

    # A sale belongs to the last segment of its unit that begins no later: a new one splits the one before.
    n, m = len(of_segment), len(of_sale)
    both = np.lexsort((np.arange(n + m), np.repeat([0, 1], [n, m]), np.concatenate([segments["at"], sales["at"]]), np.concatenate([of_segment, of_sale])))
    owner = np.empty(n + m, dtype=np.int64)
    owner[both] = np.cumsum(both < n) - 1
    owner = owner[n:]

    count = np.bincount(of_segment[~is_base], minlength=units)
    count[of_control] = control["held"]
    gone = np.ones(m, dtype=bool) if last else sales["at"] == NEVER if horizon is None else (sales["at"] == NEVER) | (sales["at"] < horizon)
    of, at = owner[gone], np.flatnonzero(gone)
    found = (~is_base[of] | ((segments["flags"][of] & CARRY) > 0)) & (sales["at"][at] != NEVER)
    out = pd.DataFrame({
        "rec": "sale", "id": _nullable(sales["id"][at], (sales["flags"][at] & ID) > 0), "batch": batch, "n_held": _nullable(count[of_sale[at]], np.ones(len(at), dtype=bool)),
        "change_id": _nullable(segments["id"][of], found & ((segments["flags"][of] & ID) > 0)), "balance_cents": _nullable(segments["cents"][of], found & ((segments["flags"][of] & CENTS) > 0)), "op": np.where(found, segments["op"][of], None),
    })
    if late.any():
        none = _nullable(np.zeros(int(late.sum())), np.zeros(int(late.sum()), dtype=bool))
        out = pd.concat([out, pd.DataFrame({"rec": "late", "id": _nullable(rows["id"][late], (rows["flags"][late] & ID) > 0), "batch": batch, "n_held": none, "change_id": none, "balance_cents": none, "op": None})])

    stay = np.ones(n, dtype=bool)
    if horizon is not None:
        passed = ~is_base & (segments["at"] <= horizon)
        at = np.flatnonzero(passed)
        # Of a unit's passed versions, which stand together, the last stays.
        stay[at] = np.append(of_segment[at][1:] != of_segment[at][:-1], True) if len(at) else False
    owner = owner[~gone]
    full = np.bincount(owner, minlength=n) > 0
    stay &= ~is_base | full
    if not stay.any() or last:
        return out, None
    number = np.cumsum(stay) - 1
    left = _taken(sales, ~gone)
    return out, _pack(_taken(segments, stay), left, number[owner])


def _turns(batch: int, late_before: int | None, horizon: int | None, last: bool):
    """The work of one start of the stream: the batch's number, watermark and horizon hold for all of its rows."""
    names = [x.split()[0] for x in EVENT.split(", ")]

    def work(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        came = pd.concat(list(rows), ignore_index=True)
        came = came[came["kind"] != TICK]
        held = bytes(state.get[0]) if state.exists else None
        if held is None and not len(came):
            return
        out, left = turn(held, {n: came[n].to_numpy() for n in names}, batch, late_before, horizon, last)
        if left is not None:
            state.update((left,))
        elif held is not None:
            state.remove()
        if len(out):
            yield out

    return work


def enrich(sales: DataFrame, changes: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """rec, id, batch, n_held, change_id, balance_cents, op: every sale as it was emitted, and every late change.

    ``sales`` (sale_id, client_id, sold_at, arrived_at) and distinct rows of ``changes`` (change_id, client_id, seq,
    op, valid_at, source, segment, city, balance); other columns are left out. Changes without valid_at are ignored. A
    sale without sold_at is emitted in the batch it comes in, without a version; one without a client has none and
    n_held 0. Unknown days of arrival count as the last batch. A change without a client can be late, but is nobody's
    version; null ids are emitted as null and are the first in order. A balance that is null, no number or beyond 9e16
    gives null balance_cents. Versions that agree in time and id are in order of balance and op. Repeated sales are
    each emitted. Empty tables give the rows of the other; every batch runs, empty or not.
    """
    spark = prepare(sales.sparkSession)
    root = f"{shared_dir(spark)}/siglane/enrich-{uuid.uuid4().hex}"
    s, c = _sales(sales, plan), _changes(changes, plan)
    light = sales.select(F.col("client_id").cast("long").alias("client"), _micros(F.col("sold_at")).alias("at")).unionByName(changes.select(F.col("client_id").cast("long").alias("client"), _micros(F.col("valid_at")).alias("at")))
    total = sales.count() + changes.count()
    buckets = max(LEAST_BUCKETS, -(-total // BUCKET_ROWS))
    hot_path = f"{root}/hot"
    clients, bounds = _hot(light, total)
    bounds.write.parquet(hot_path)
    hot = spark.read.parquet(hot_path)
    staged = f"{root}/staged"
    _dealt(s, hot, buckets).write.mode("append").partitionBy("batch").parquet(staged)
    _dealt(c, hot, buckets).write.mode("append").partitionBy("batch").parquet(staged)
    events = spark.read.schema(f"{EVENT}, batch int").parquet(staged)
    late, horizon = _watermarks(events, plan)
    ticks = spark.range(buckets).select(F.lit(TICK).cast("byte").alias("kind"), F.col("id").cast("int").alias("bucket"), F.lit(0).cast("long").alias("client"), F.lit(0).alias("slice"), F.lit(0).cast("long").alias("id"), F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("cents"), F.lit(None).cast("string").alias("op"), F.lit(0).alias("flags"), F.lit(0).cast("long").alias("held"), F.explode(F.sequence(F.lit(0), F.lit(plan.batches))).alias("batch"))
    controls = _placed(_controls(events.filter(F.col("kind") == CHANGE), clients, hot, late, horizon, plan), buckets)
    extra = f"{root}/extra"
    controls.unionByName(ticks.select(*controls.columns)).coalesce(8).write.partitionBy("batch").parquet(extra)
    _run(spark, root, (staged, extra), late, horizon, plan)
    found = f"{root}/out"
    if (made := common._scratch.get()) is not None:
        made.append((spark, root))
    files, _ = file_system(spark, root)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for name in ("hot", "staged", "extra", "arrived", "checkpoint"):
        files.delete(path(f"{root}/{name}"), True)
    return spark.read.schema(RESULT).parquet(found)


def _watermarks(events: DataFrame, plan: Plan) -> tuple[list[int | None], list[int | None]]:
    """(watermark of changes, horizon) of each batch, from at most two maxima a batch."""
    most = {(r["kind"], r["batch"]): r["at"] for r in events.filter(F.col("at") != NEVER).groupBy("kind", "batch").agg(F.max("at").alias("at")).collect()}
    late, horizon, seen = [], [], {SALE: None, CHANGE: None}
    for b in range(plan.batches):
        mark = {k: None if v is None else v - plan.lag_micros for k, v in seen.items()}
        late.append(mark[CHANGE])
        horizon.append(None if None in mark.values() else min(mark.values()))
        for k in seen:
            here = most.get((k, b))
            seen[k] = here if seen[k] is None else seen[k] if here is None else max(seen[k], here)
    return late, horizon


def _run(spark: SparkSession, root: str, folders: tuple[str, ...], late: list, horizon: list, plan: Plan) -> None:
    """Moves one batch after the other to where the stream looks for files, and starts it for each."""
    files, _ = file_system(spark, root)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files.mkdirs(path(f"{root}/arrived"))
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:
        for b in range(plan.batches + 1):
            for k, folder in enumerate(folders):
                if files.exists(path(f"{folder}/batch={b}")) and not files.rename(path(f"{folder}/batch={b}"), path(f"{root}/arrived/{b}-{k}")):
                    raise OSError(f"{folder}/batch={b} can't be moved")
            last = b == plan.batches
            work = _turns(b, None if last else late[b], None if last else horizon[b], last)
            rows = spark.readStream.schema(EVENT).option("recursiveFileLookup", "true").parquet(f"{root}/arrived")
            out = rows.groupBy("bucket").applyInPandasWithState(work, RESULT, "segments binary", "append", GroupStateTimeout.NoTimeout)
            query = out.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").outputMode("append").trigger(availableNow=True).start()
            query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
