"""Sharding: balanced label propagation over groups of linked documents, then an exact evening-out.

Documents of equal text are linked. Their graph is kept as stars around a hub for each group, so a group of n has n edges.
A group larger than half a shard's quota is split by hash into parts that fit. Every document starts in a shard by its
hash. In each round every hub counts the present labels of its documents by a join over the star's edges (combined in each task
before the shuffle) and asks for the commonest that has room for all of them, else for any shard that has; requests are granted, by
sums over hash buckets of the hubs, as far as a shard's quota has room, and one that does not fit holds up no other; then the documents
take their hub's label. An edge is cut where a document and its hub's commonest label differ. Rounds go on as long as the number of cut
edges falls. In the end the shards' numbers of rows are made equal, or one apart, by moving rows out of full shards, those of whole
groups last. Only tables of shards x buckets reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfold.llm.tables import Scratch, running, text_of, uniform_key

BUCKETS = 1024
#: Repeats of a row that stay together.
STACK = 1024


def vertices(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, digest): UTF-8 bytes of the text plus 8; a null text has no bytes."""
    data = text_of().cast("binary")
    return docs.select("doc_id", (F.octet_length(text_of()) + 8).cast("bigint").alias("size"), F.crc32(data).alias("text_crc32"), F.unhex(F.sha2(data, 256)).alias("digest"))


def _fill(asked: list[tuple], room: list[int], placed: list[tuple]) -> None:
    """Grants (name, rows, shards in order of preference) in turn, to the first shard with room; one that fits nowhere is passed over."""
    for name, n, wishes in asked:
        target = next((s for s in wishes if n <= room[s]), None)
        if target is not None:
            room[target] -= n
            placed.append((name, target))


def _round(hubs: DataFrame, asking: DataFrame, room: list[int], quota: int, salt: int) -> DataFrame | None:
    """(cluster, home): the hubs that get a shard in this round; None if none does.

    Groups of a BUCKETS-th of the shards' rows or more, of which there are at most BUCKETS and a few, ask one by one, the largest
    first. The others ask in hash buckets, that hold about an eighth of the largest room at most; where no bucket fits any more, the
    smallest groups ask one by one.
    """
    spark, shards = hubs.sparkSession, len(room)
    by_room = lambda: sorted(range(shards), key=lambda s: (-room[s], s))

    def one_by_one(rows: list) -> list[tuple]:
        placed: list[tuple] = []
        for r in rows:
            _fill([(r.cluster, r.rows, [*r.wishes, *by_room()])], room, placed)
        return placed

    large = max(2, quota * shards // BUCKETS)
    placed = one_by_one(asking.where(F.col("rows") >= large).orderBy(F.desc("rows"), "cluster").collect())
    found = spark.createDataFrame(placed, "cluster bigint, home int") if placed else None
    small = asking.where((F.col("rows") < large) & (F.col("rows") <= max(room)))
    left = small.agg(F.sum("rows")).first()[0]
    if not left:
        return found
    rooms = F.array(*[F.lit(r).cast("bigint") for r in room])
    own = F.get(F.filter("wishes", lambda s: F.get(rooms, s) >= F.col("rows")), F.lit(0))
    others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.get(rooms, s) >= F.col("rows"))
    drawn = F.pmod(F.xxhash64("cluster", F.lit(salt), F.lit("any")), F.size(others).cast("bigint")).cast("int")
    buckets = max(BUCKETS, 8 * left // max(room))
    bucket = F.pmod(F.xxhash64("cluster", F.lit(salt)), F.lit(buckets))
    asked = small.select("cluster", "rows", F.coalesce(own, F.get(others, drawn)).cast("int").alias("wanted"), bucket.alias("bucket")).where(F.col("bucket") < BUCKETS)
    granted: list[tuple] = []
    for r in asked.groupBy("wanted", "bucket").agg(F.sum("rows").alias("n")).orderBy("bucket", "wanted").collect():
        _fill([((r.wanted, r.bucket), r.n, [r.wanted])], room, granted)
    if granted:
        table = spark.createDataFrame([(w, b, s) for (w, b), s in granted], "wanted int, bucket bigint, home int")
        homes = asked.join(F.broadcast(table), ["wanted", "bucket"]).select("cluster", "home")
        return homes if found is None else found.union(homes)
    placed = one_by_one(small.orderBy("rows", "cluster").limit(16 * BUCKETS).collect())
    if not placed:
        return found
    homes = spark.createDataFrame(placed, "cluster bigint, home int")
    return homes if found is None else found.union(homes)


def _propagate(linked: DataFrame, shards: int, quota: int, scratch: Scratch, progress: list[int] | None = None) -> DataFrame:
    """(uid, label, free) of the rows (uid, cluster, label): free = 0 where the whole group is in one shard, else 1.

    ``progress`` gets the number of cut edges before each round and after the last. Rows that are still scattered take no room, as they
    leave or stay last.
    """
    labels, before, salt = linked, None, 0
    while True:
        counts = labels.groupBy("cluster", "label").agg(F.count("*").alias("n"))
        ranked = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "label"))), lambda x: x["label"])
        hubs = scratch.save(counts.groupBy("cluster").agg(F.sum("n").alias("rows"), F.max("n").alias("most"), ranked.alias("wishes")))
        cut = hubs.agg(F.sum(F.col("rows") - F.col("most"))).first()[0] or 0
        if progress is not None:
            progress.append(cut)
        if not cut or (before is not None and cut >= before):
            break
        before, salt = cut, salt + 1
        room = [quota] * shards
        for r in hubs.where("size(wishes) = 1").groupBy(F.get("wishes", F.lit(0)).alias("s")).agg(F.sum("rows").alias("n")).collect():
            room[r.s] = max(0, quota - r.n)
        homes = _round(hubs, hubs.where("size(wishes) > 1"), room, quota, salt)
        if homes is None:
            break
        # Over the star's edges: documents take their hub's label.
        moved = labels.join(scratch.save(homes), "cluster", "left")
        labels = scratch.save(moved.select("uid", "cluster", F.coalesce("home", "label").alias("label")))
    whole = hubs.where("size(wishes) = 1").select("cluster", F.lit(0).alias("free"))
    return scratch.save(labels.join(whole, "cluster", "left").select("uid", "label", F.coalesce("free", F.lit(1)).alias("free")))


def shard(docs: DataFrame, scratch: Scratch, shards: int = 24, progress: list[int] | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): shards of equal numbers of rows, or one apart; slots gapless from 0.

    A null text is linked with empty texts. Rows that repeat a doc_id, even with the same text, are rows of their own. A
    null doc_id is a value like others. No rows give no rows. With fewer rows than shards some shards stay empty. ``progress``, a list,
    gets the number of cut edges of each round.
    """
    found = vertices(docs)
    # Repeats of a row are counted, and dealt out in stacks, so that every row has an id that follows from the contents and no task
    # numbers all repeats of one.
    columns = ["doc_id", "size", "text_crc32", "digest"]
    stacks = found.groupBy(*columns).agg(F.count("*").alias("n")).withColumn("stack", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / STACK).cast("int"))))
    spread = stacks.where("stack = 0 and n <= 1").union(stacks.where("n > 1").repartition("doc_id", "digest", "stack"))
    copies = F.least(F.lit(STACK), F.col("n") - F.col("stack") * STACK).cast("int")
    found = spread.select(*columns, "stack", F.explode(F.sequence(F.lit(1), copies)).alias("copy"))
    found = found.withColumn("uid", uniform_key("doc_id", "digest", "stack", "copy")).drop("stack", "copy")
    found = scratch.save(found.withColumn("label", F.pmod("uid", F.lit(shards)).cast("int")))
    rows = found.count()
    quota = rows // shards
    part = max(1, quota // 2)
    # Written, so that a join with it can split a group that many rows share.
    groups = scratch.save(found.groupBy("digest").agg(F.count("*").alias("copies")).where("copies > 1"))
    parts = F.ceil(F.col("copies") / part).cast("bigint")
    linked = found.join(groups, "digest").select("uid", F.xxhash64("digest", F.pmod(F.xxhash64("uid"), parts)).alias("cluster"), "label")
    linked = _propagate(scratch.save(linked), shards, quota, scratch, progress)
    placed = found.drop("label", "digest").join(linked, "uid", "left")
    start = F.pmod("uid", F.lit(shards)).cast("int")
    placed = placed.withColumn("label", F.coalesce("label", start)).withColumn("free", F.coalesce("free", F.lit(1)))
    placed = scratch.save(placed.withColumn("key", uniform_key("uid", seed=3)))

    # Whole groups come first in a shard, so that the rows beyond its share are unlinked or scattered ones.
    counts = {(r.label, r.free): r.n for r in placed.groupBy("label", "free").agg(F.count("*").alias("n")).collect()}
    have = [counts.get((s, 0), 0) + counts.get((s, 1), 0) for s in range(shards)]
    larger = sorted(range(shards), key=lambda s: (-have[s], s))[: rows % shards]
    want = [quota + (s in larger) for s in range(shards)]
    by_shard = lambda values: F.get(F.array(*[F.lit(v).cast("bigint") for v in values]), F.col("label"))
    place = running(placed, ["label", "free"], "key", ["uid"], rows)
    place = place.withColumn("slot", F.col("before") + F.when(F.col("free") == 1, by_shard([counts.get((s, 0), 0) for s in range(shards)])).otherwise(0))
    over = [max(0, have[s] - want[s]) for s in range(shards)]
    under = [max(0, want[s] - have[s]) for s in range(shards)]
    moved = F.col("slot") - by_shard(want) + by_shard([sum(over[:s]) for s in range(shards)])
    target, slot = F.col("label"), F.col("slot")
    for s in range(shards):
        begin = sum(under[:s])
        here = F.col("leaves") & (F.col("moved") >= begin) & (F.col("moved") < begin + under[s])
        target = F.when(here, s).otherwise(target)
        slot = F.when(here, F.col("moved") - begin + have[s]).otherwise(slot)
    place = place.withColumn("leaves", F.col("slot") >= by_shard(want)).withColumn("moved", moved)
    return place.select("doc_id", "size", "text_crc32", target.cast("int").alias("shard"), slot.cast("bigint").alias("slot"))
