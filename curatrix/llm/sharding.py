"""Sharding by balanced label propagation.

Documents that share a link key (here: equal texts) are neighbours through that key, so a group of any size costs a
row per member, never a pair. Each round counts, per key, how many members every shard holds (sums made before the
shuffle), joins the fullest shards back and lets the other members move there, as many as the shard's quota takes.
Keys larger than a quota spread over as few shards as hold them. At last unlinked documents fill up what is missing,
so that shard counts differ by one at most. The driver sees a row per shard (or per shard and bucket), no document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatrix.llm.common import materialize

SHARDS = 24
ROUNDS = 4
#: Ranks inside a shard are counted by buckets of linked and of unlinked documents: so many at least, of so many rows about.
BUCKETS, BUCKET_ROWS = 128, 250_000
#: Repeated rows that are numbered in one piece.
REPEATS = 10_000
HOT = 1000


def _pick(values: list, by: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), by + 1)


def _share(*cols) -> Column:
    """A number in [0, 1) that follows from the columns' values."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 20)) / float(1 << 20)


def join_by_key(rows: DataFrame, keyed: DataFrame, size: str, n_rows: int, how: str = "inner") -> DataFrame:
    """``rows`` joined with one row per key; keys that hold over a HOT-th of all rows are few, whatever the input, and are
    sent to every task, so their members stay where they are."""
    hot = F.broadcast(keyed.where(F.col(size) * HOT > n_rows).drop(size).withColumn("_hot", F.lit(True)))  # under HOT rows
    at_once = rows.join(hot, ["k1", "k2"], "left")
    rest = at_once.where("_hot is null").select(*rows.columns).join(keyed.where(F.col(size) * HOT <= n_rows).drop(size), ["k1", "k2"], how)
    return at_once.where("_hot").select(*rest.columns).unionByName(rest)


def accepted(room: list[int], flow: dict[tuple[int, int], int]) -> dict[tuple[int, int], float]:
    """The share of the applicants from one shard to another that may go, such that the most do and no shard overflows.

    What leaves a shard makes room in it. At first all go; then the load of an overfull shard is passed on, along the
    cheapest path of moves taken back (or granted again), to shards with room. There are as many nodes as shards.
    """
    flow = dict(sorted(flow.items()))  # of several best flows always the same one
    going, load = dict(flow), [-r for r in room]
    for (a, b), n in flow.items():
        load[a] -= n
        load[b] += n
    for over in range(len(room)):
        while load[over] > 0:
            cost, step = {over: 0}, {}
            for _ in range(len(room)):
                before = dict(cost)
                for (a, b), n in flow.items():
                    for frm, to, price, some in ((b, a, 1, going[(a, b)]), (a, b, -1, n - going[(a, b)])):
                        if some and frm in cost and cost[frm] + price < cost.get(to, 1 << 30):
                            cost[to], step[to] = cost[frm] + price, (a, b)
                if cost == before:
                    break
            free = [s for s in cost if load[s] < 0]
            if not free:
                break
            at = min(free, key=lambda s: (cost[s], s))
            path, some = [], min(load[over], -load[at])
            end = at
            while at != over:
                a, b = step[at]
                path.append((a, b, at == a))
                some = min(some, going[(a, b)] if at == a else flow[(a, b)] - going[(a, b)])
                at = b if at == a else a
            for a, b, back in path:
                going[(a, b)] += -some if back else some
            load[over] -= some
            load[end] += some
    return {k: going[k] / n for k, n in flow.items()}


def propagate(rows: DataFrame, n_rows: int, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``rows(rid, k1, k2, linked, shard, ...)`` with linked members moved towards their key's fullest shards."""
    quota, settled = -(-n_rows // shards), {}
    for step in range(rounds):
        held = dict(rows.where("linked").groupBy("shard").count().collect())
        if not held:
            return rows
        free = [settled.get(s, 0) < 0.95 * quota for s in range(shards)]
        cells = rows.where("linked").groupBy("k1", "k2", "shard").agg(F.count(F.lit(1)).alias("n"))
        best = (
            cells.withColumn("free", _pick(free, F.col("shard")))
            .groupBy("k1", "k2")
            .agg(F.sum("n").alias("members"), F.max("n").alias("most"), F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), F.xxhash64("k1", "shard").alias("tie"), "shard", "free"))).alias("found"))
            .withColumn("found", F.filter("found", lambda x: x["free"] | (-x["n"] == F.col("most"))))
            .withColumn("good", F.transform(F.slice("found", 1, F.ceil(F.col("members") / F.lit(float(quota))).cast("int")), lambda x: x["shard"]))
            .select("k1", "k2", "good", "members")
        )
        wish = join_by_key(rows.where("linked"), best, "members", n_rows)
        to = F.element_at("good", (F.pmod(F.xxhash64("rid", F.lit(step)), F.size("good")) + 1).cast("int"))
        wish = wish.withColumn("to", F.when(F.array_contains("good", F.col("shard")), F.col("shard")).otherwise(to)).drop("good")
        wish = materialize(wish.unionByName(rows.where("not linked").withColumn("to", F.col("shard"))), "wishes")
        flow = {(a, b): n for a, b, n in wish.where("linked").groupBy("shard", "to").count().collect()}
        settled = {a: n for (a, b), n in flow.items() if a == b}
        flow = {k: n for k, n in flow.items() if k[0] != k[1]}
        if not flow:
            return wish.drop("to")
        share = accepted([quota - held.get(s, 0) for s in range(shards)], flow)
        if not any(share.values()):
            return wish.drop("to")
        shares = [share.get((a, b), 0.0) for a in range(shards) for b in range(shards)]
        go = (F.col("to") != F.col("shard")) & (_share("rid", F.lit(-step - 1)) < _pick(shares, F.col("shard") * shards + F.col("to")))
        rows = wish.withColumn("shard", F.when(go, F.col("to")).otherwise(F.col("shard"))).drop("to")
    return rows


def even_out(rows: DataFrame, n_rows: int, shards: int = SHARDS) -> DataFrame:
    """Final ``shard`` and gapless ``slot``; a shard's last ranks (unlinked documents) move to shards that lack rows."""
    buckets = max(BUCKETS, n_rows // (shards * BUCKET_ROWS))
    part = F.pmod("rid", F.lit(buckets)).cast("int") + F.when(F.col("linked"), 0).otherwise(buckets)
    rows = materialize(rows.withColumn("part", part), "dealt")
    counts = {(r[0], r[1]): r[2] for r in rows.groupBy("shard", "part").count().collect()}
    have = [sum(counts.get((s, p), 0) for p in range(2 * buckets)) for s in range(shards)]
    # the fullest shards get the extra rows
    more = sorted(range(shards), key=lambda s: (-have[s], s))[: n_rows % shards]
    want = [n_rows // shards + (s in more) for s in range(shards)]
    offsets, moved, filled, out_at, in_at = [], [], [], 0, []
    for s in range(shards):
        at = 0
        for p in range(2 * buckets):
            offsets.append((s, p, at))
            at += counts.get((s, p), 0)
        moved.append(out_at)
        out_at += max(0, have[s] - want[s])
    at = 0
    for s in range(shards):
        in_at.append(at)
        at += max(0, want[s] - have[s])
    ranks = rows.sparkSession.createDataFrame(offsets, "shard int, part int, base long")  # a row per shard and bucket
    at = F.row_number().over(Window.partitionBy("shard", "part").orderBy("rid", "doc_id", "k1", "k2")) - 1
    ranked = rows.withColumn("at", at).join(F.broadcast(ranks), ["shard", "part"]).withColumn("rank", F.col("base") + F.col("at"))
    over = F.col("rank") >= _pick(want, F.col("shard"))
    ranked = ranked.withColumn("turn", F.when(over, _pick(moved, F.col("shard")) + F.col("rank") - _pick(want, F.col("shard"))))
    target = F.coalesce(*[F.when(F.col("turn") >= in_at[s], F.lit(s)) for s in reversed(range(shards)) if want[s] > have[s]], F.lit(None).cast("int"))
    ranked = ranked.withColumn("target", F.when(over, target))
    slot = F.when(over, _pick(have, F.col("target")) + F.col("turn") - _pick(in_at, F.col("target"))).otherwise(F.col("rank"))
    return ranked.withColumn("slot", slot.cast("long")).withColumn("shard", F.coalesce("target", "shard"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Every document with ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard``, under the law ``rows``.

    Equal texts are linked; null texts count as equal to each other and to the empty text. Repeated rows are rows like
    others: they are counted and numbered, so that the result follows from the rows alone and not from where they lie. Ties
    are broken by hashes of the row. A text of any length costs its hashes. An empty table gives no row. Other columns are
    not looked at, so their names cannot clash. With fewer rows than shards some stay empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    counted = docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"),
    ).groupBy("doc_id", "size", "text_crc32", "k1", "k2").agg(F.count(F.lit(1)).alias("times"))
    pieces = counted.withColumn("piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("times") - 1) / REPEATS).cast("int"))))
    pieces = pieces.repartition("doc_id", "k1", "piece")  # a row that stands very often is numbered by several tasks
    first = F.col("piece").cast("long") * REPEATS
    number = F.explode(F.sequence(first, F.least(first + (REPEATS - 1), F.col("times") - 1)))
    rows = pieces.select("doc_id", "size", "text_crc32", "k1", "k2", number.alias("number")).withColumn("rid", F.xxhash64("doc_id", "k1", "k2", "number")).drop("number")
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("rid"), F.lit(shards)).cast("int"))
    rows = materialize(rows, "documents")
    n_rows = rows.count()
    groups = rows.groupBy("k1", "k2").count().where("count > 1").select("k1", "k2", F.lit(True).alias("several"), "count")
    rows = join_by_key(rows, groups, "count", n_rows, "left").withColumn("linked", F.coalesce("several", F.lit(False))).drop("several")
    done = even_out(propagate(materialize(rows, "linked"), n_rows, shards, rounds), n_rows, shards)
    return done.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
