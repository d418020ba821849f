"""N-gram Jaccard join: parity sketches by size band, joined by the pigeonhole principle, then verified.

A document is the set of its five-word shingles. Its sketch has one bit for each possible hash, set where an odd number of
shingles hash to it, so that two sketches differ in at most as many bits as their sets. Wide as it is, it is kept by parts:
the part that a hash falls in has as value the XOR of words drawn for its set bits. Sets of n and m shingles are linked
(100 * intersection >= 75 * union) only if they differ in at most d = (n + m) / 7 shingles, and so in at most d parts.

Bands hold sizes [2^i, 2^(i+1)). All sets of a band, and those of the band below that can link into it, use as many parts. A set of n
emits the first n/3 + 1 + n/6 of its parts that hold something, in an order that is the same for all sets; of a linked pair's
emitted parts at least t = (the smaller number) - d agree. A pair is a candidate if t of its parts agree. In that order parts known
to be hot come last: those that many sets of a sample share, as copies and passages of many documents make them. So a set that has
enough of its own emits nothing that is hot, however long a common passage it holds.

Emitted parts go to buckets as packed arrays. A bucket counts, for every pair, the parts it shares in groups of up to HOT sets. Larger
groups are not expanded: parts known to be hot do not go to buckets at all, and of one that turns out to be hot a bucket gets at most
HOT + 1 sets from a pack, enough to know it by. Their sets learn how many of their emitted parts are hot: a set with few
of them is "calm" and shares a cool part with each partner, so its hot parts may go. The others have almost nothing but hot parts:
copies, or texts put together from common passages. Each is compared with the set of its hot groups that has the most hot parts, which joins
copies to one component; then, in a group of several components, the sets outside the largest are compared with the others by their bit
sketches, in tiles. So the components are those of all links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapfold.llm.buffers import U, mix, pack, runs_of, shingle_sets
from snapfold.llm.tables import Scratch, components, map_texts

HOT, TILE = 64, 2048
#: One of so many sets tells which parts are hot: those that SEEN sampled sets have, the HOT_KEYS most frequent ones, as bits of a table.
SAMPLE, SEEN, HOT_KEYS, TABLE_BITS = 16, 4, 1 << 20, 25
#: Bytes of text whose parts one bucket holds on average, and parts a task packs at a time, however long its texts are.
BUCKET_BYTES, PACKED = 8 << 20, 1 << 20
#: Pairs of postings looked at, and pairs that wait to be counted, at a time.
STEP, WAITING = 1 << 18, 1 << 20
_SECOND, _POOR = 1, 2


def set_id(shingles: np.ndarray) -> int:
    """64 bits of a set, as a signed number; equal sets agree."""
    both = np.array([np.bitwise_xor.reduce(mix(shingles)), shingles.sum(dtype=U) + U(len(shingles))])
    return int((mix(both) * np.array([1, 3], U)).sum(dtype=U).astype(np.int64))


def schemes(n: int) -> list[int]:
    """The band of a set of n shingles, and the next if a set in it can link with this one."""
    band = n.bit_length() - 1
    return [band, band + 1] if 4 * n >= 3 * (2 << band) else [band]


def emitted(n: int | np.ndarray) -> int | np.ndarray:
    return n // 3 + 1 + n // 6


def hot_table(keys: np.ndarray) -> np.ndarray:
    """A table of TABLE_BITS bits with those of ``keys`` set; a few others share a bit with one of them."""
    bit = keys & U((1 << TABLE_BITS) - 1)
    table = np.zeros(1 << TABLE_BITS - 3, np.uint8)
    np.bitwise_or.at(table, (bit >> U(3)).astype(np.int64), (U(1) << (bit & U(7))).astype(np.uint8))
    return table


def all_parts(shingles: np.ndarray, scheme: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all parts of a set in a scheme that hold something, by number, and how many shingles each holds."""
    n, parts = len(shingles), max(128, 2 << scheme)
    part = (shingles % U(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    ranked = part[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    number, count = ranked[first], np.diff(np.append(first, n))
    value = np.bitwise_xor.reduceat(mix(shingles[order] ^ U(0x5BD1E9955BD1E995)), first)
    return mix(value ^ mix((number + (count << 36) + (scheme << 56)).astype(U))), count


def part_keys(shingles: np.ndarray, scheme: int, table: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, bool]:
    """The keys of the first parts of a set in a scheme; whether each is known as hot; whether the set has fewer than it should emit.

    Order: cool parts before hot ones, more shingles first, then by number.
    """
    n = len(shingles)
    keys, count = all_parts(shingles, scheme)
    poor = len(keys) < emitted(n)
    if len(keys) <= n // 3:  # so few parts that all which agree may be empty ones: such sets meet here
        keys, count = np.append(keys, mix(np.array([scheme + 1], U))), np.append(count, n + 1)
    hot = np.zeros(len(keys), bool)
    if table is not None:
        bit = keys & U((1 << TABLE_BITS) - 1)
        hot = (table[(bit >> U(3)).astype(np.int64)] >> (bit & U(7)).astype(np.uint8) & 1).astype(bool)
    chosen = np.lexsort((-count, hot))[: emitted(n)]
    return keys[chosen], hot[chosen], poor


def bit_sketch(shingles: np.ndarray) -> bytes:
    """One bit a shingle, toggled; eight to sixteen bits for each, in powers of two, so that sizes compare by folding."""
    bits = 64 << max(0, (len(shingles) - 1).bit_length() - 3)
    flags = np.bincount((shingles >> U(20)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(flags.astype(np.uint8), bitorder="little").tobytes()


def fold(sketches: np.ndarray, words: int) -> np.ndarray:
    """Rows of 64-bit words folded to fewer; bits that fall together are XORed, so the distance bound holds on."""
    while sketches.shape[1] > words:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= 75 * (len(a) + len(b) - common)


def document_sets(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` without its text, with n_shingles, set_id (null for documents without words) and the parts of one set in ``sample``."""

    def sized(texts: list[str | None]) -> list:
        sets = list(shingle_sets(texts))
        names = [set_id(s) if len(s) else None for s in sets]
        parts = [np.concatenate([all_parts(s, x)[0] for x in schemes(len(s))]).astype(np.int64) if n is not None and n % sample == 0 else None for s, n in zip(sets, names, strict=True)]
        return [[len(s) for s in sets], names, parts]

    return map_texts(docs, sized, "n_shingles bigint, set_id bigint, parts array<bigint>")


def hot_parts(members: DataFrame) -> np.ndarray | None:
    """The table of the parts that many sampled sets have; None if there are none. At most HOT_KEYS numbers reach the driver."""
    sampled = members.where("parts is not null").select("set_id", "parts").dropDuplicates(["set_id"])
    counts = sampled.select(F.explode("parts").alias("key")).groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= SEEN)
    keys = counts.orderBy(F.desc("n"), "key").limit(HOT_KEYS).select("key").toArrow().column("key").to_numpy()
    return hot_table(keys.astype(U)) if len(keys) else None


def _packed(docs: DataFrame, buckets: int, table: Broadcast | None = None) -> DataFrame:
    """(bucket, ids, info, owner, keys): the emitted parts of many sets, those of one bucket in one row.

    A bucket gets no part that is known to be hot, and at most HOT + 1 sets of any other from each pack. What else a pack has is a row with
    a negative number of its own as bucket, whose keys are whole codes.
    """

    def rows(held: dict[int, tuple[int, np.ndarray, np.ndarray]], number: int) -> Iterator[pd.DataFrame]:
        ids = np.array([i for i, _ in held], np.int64)
        info = np.array([v[0] for v in held.values()], np.uint32)
        owner = np.repeat(np.arange(len(held), dtype=np.uint32), [len(v[1]) for v in held.values()])
        keys, known = (np.concatenate([v[i] for v in held.values()]) for i in (1, 2))
        code = (keys >> U(32)) % U(buckets) << U(32) | keys & U(0xFFFFFFFF)
        hot_code, hot_owner, code, owner = code[known], owner[known], code[~known], owner[~known]
        order = np.argsort(code, kind="stable")
        code, owner = code[order], owner[order]
        new = np.ones(len(code), bool)
        new[1:] = (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])
        code, owner = code[new], owner[new]
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.empty(0, np.int64)
        place = np.arange(len(code)) - np.repeat(first, np.diff(np.append(first, len(code))))
        out = []
        c, o = code[place <= HOT], owner[place <= HOT]
        for bucket, s in runs_of((c >> U(32)).astype(np.int64)):
            used, own = np.unique(o[s], return_inverse=True)
            out.append((bucket, *pack(ids[used], info[used], own.astype(np.uint32), (c[s] & U(0xFFFFFFFF)).astype(np.uint32))))
        # The HOT + 1 sets of a group that its bucket gets make it hot there, so the rest need not be looked at again.
        c, o = np.append(code[place > HOT], hot_code), np.append(owner[place > HOT], hot_owner)
        if len(c):
            used, own = np.unique(o, return_inverse=True)
            out.append((-1 - number, *pack(ids[used], info[used], own.astype(np.uint32), c)))
        yield pd.DataFrame(out, columns=["bucket", "ids", "info", "owner", "keys"])

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[int, int], tuple[int, np.ndarray, np.ndarray]] = {}
        size, packs, task = 0, 0, TaskContext.get().partitionId()
        known_hot = table.value if table is not None else None
        for batch in batches:
            for shingles in shingle_sets(batch["text"].tolist()):
                if not len(shingles):
                    continue
                name = set_id(shingles)
                for second, scheme in enumerate(schemes(len(shingles))):
                    if (name, second) not in held:
                        keys, known, poor = part_keys(shingles, scheme, known_hot)
                        held[name, second] = (len(shingles) << 2 | _POOR * poor | _SECOND * second, keys, known)
                        size += len(keys)
                if size >= PACKED:
                    yield from rows(held, (task << 12 ^ packs) & 0x7FFFFFFF)
                    held, size, packs = {}, 0, packs + 1
        if held:
            yield from rows(held, (task << 12 ^ packs) & 0x7FFFFFFF)

    return docs.select("text").mapInPandas(emit, "bucket int, ids binary, info binary, owner binary, keys binary")


def _counted(code: np.ndarray, times: np.ndarray, more: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and how often each came, with those that waited added."""
    if not more:
        return code, times
    new, n = np.unique(np.concatenate(more), return_counts=True)
    both, place = np.unique(np.concatenate([code, new]), return_inverse=True)
    return both, np.bincount(place, np.concatenate([times, n]), len(both)).astype(np.int64)


def _warm(sets: np.ndarray, codes: np.ndarray, info: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"kind": 1, "a": sets, "b": codes.astype(np.int64), "times": 0, "need": 0, "info": info.astype(np.int64)})


def _agreeing(bucket: int, frame: pd.DataFrame) -> pd.DataFrame:
    """Kind 0: pairs (a, b) with the number of parts that agree and the number needed; kind 1: (set, info, hot key)."""
    if bucket < 0:
        kinds = (("ids", np.int64), ("info", np.uint32), ("owner", np.uint32), ("keys", U))
        packs = ([np.frombuffer(row[c], kind) for c, kind in kinds] for row in frame.to_dict("records"))
        return pd.concat([_warm(ids[owner], codes, info[owner]) for ids, info, owner, codes in packs])
    ids = [np.frombuffer(x, np.int64) for x in frame["ids"]]
    infos = np.concatenate([np.frombuffer(x, np.uint32) for x in frame["info"]])
    shift = np.cumsum([0, *map(len, ids)])
    owner = np.concatenate([np.frombuffer(x, np.uint32) + s for x, s in zip(frame["owner"], shift[:-1], strict=True)])
    keys = np.concatenate([np.frombuffer(x, np.uint32) for x in frame["keys"]])
    every = np.concatenate(ids)
    # One number for each (set, scheme), however many tasks met a copy of it.
    order = np.lexsort((infos, every))
    new = np.concatenate([[True], (every[order][1:] != every[order][:-1]) | (infos[order][1:] != infos[order][:-1])])
    number = np.empty(len(every), np.int64)
    number[order] = np.cumsum(new) - 1
    sets, info = every[order][new], infos[order][new].astype(np.int64)
    posts = np.unique(keys.astype(U) << U(32) | number[owner].astype(U))
    key, who = posts >> U(32), (posts & U(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(first, len(key)))
    hot = np.repeat(size > HOT, size)
    c_key, c_who, w, w_key = key[~hot], who[~hot], who[hot], key[hot]
    del posts, key, who, hot, owner, keys, every, order, new, number
    code, times = np.empty(0, np.int64), np.empty(0, np.int64)
    waiting, size = [], 0
    for gap in range(1, HOT):
        same = np.flatnonzero(c_key[gap:] == c_key[:-gap])
        if not len(same):
            break
        for at in range(0, len(same), STEP):
            a, b = c_who[same[at : at + STEP]], c_who[same[at : at + STEP] + gap]
            n, m = info[a] >> 2, info[b] >> 2
            fit = (4 * np.minimum(n, m) >= 3 * np.maximum(n, m)) & (info[a] & info[b] & _SECOND == 0) & (sets[a] != sets[b])
            waiting.append(a[fit] << 32 | b[fit])
            size += len(waiting[-1])
            if size >= WAITING:
                code, times = _counted(code, times, waiting)
                waiting, size = [], 0
    code, times = _counted(code, times, waiting)
    a, b = code >> 32, code & 0xFFFFFFFF
    n, m = info[a] >> 2, info[b] >> 2
    poor = (info[a] | info[b]) & _POOR > 0
    need = np.where(poor, 1, np.maximum(1, np.minimum(emitted(n), emitted(m)) - (n + m) // 7))
    x, y = np.minimum(sets[a], sets[b]), np.maximum(sets[a], sets[b])
    cool = pd.DataFrame({"kind": 0, "a": x, "b": y, "times": times, "need": need, "info": 0})
    return pd.concat([cool, _warm(sets[w], w_key | U(bucket) << U(32), info[w])])


def _hot_postings(posts: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, a, info, parts) of the sets that cannot do without their hot parts, and of keys with a set that has too few parts."""
    size = F.col("info").bitwiseAND(F.lit(-4)) / 4
    poor = F.col("info").bitwiseAND(F.lit(_POOR)) > 0
    restless = (F.col("parts") > F.floor(F.ceil(size * 0.75) / 6)) | poor
    sets = posts.groupBy("a", "info").agg(F.count("*").alias("parts")).where(restless)
    poor_keys = posts.where(poor).select("key").distinct()
    kept = posts.join(sets, ["a", "info"]).select("key", "a", "info", "parts")
    extra = posts.join(poor_keys, "key", "left_semi").select("key", "a", "info", F.lit(0).cast("bigint").alias("parts"))
    return scratch.save(kept.union(extra).groupBy("key", "a", "info").agg(F.max("parts").alias("parts")))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are linked."""
    both = pairs.join(sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("left")), "a")
    both = both.join(sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("right")), "b")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = [linked(np.frombuffer(x, U), np.frombuffer(y, U)) for x, y in zip(batch["left"], batch["right"], strict=True)]
            yield batch.loc[np.array(good, bool), ["a", "b"]]

    return both.select("a", "b", "left", "right").mapInPandas(check, "a bigint, b bigint")


def _across(hot: DataFrame, roots: DataFrame, sets: DataFrame, scratch: Scratch, tile: int = TILE) -> DataFrame:
    """Pairs of sets that share a hot part, lie in different components and have sketches near enough.

    Of each part's group the sets outside its largest component ("loose" ones) meet all others. A block is a tile of loose sets and one
    of all; with few loose sets every other set is in one block alone.
    """
    rooted = hot.join(roots, hot["a"] == roots["node"], "left").select("key", "a", F.coalesce("root", "a").alias("root"))
    sizes = rooted.groupBy("key", "root").agg(F.count("*").alias("n"))
    groups = sizes.groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("largest"), F.count("*").alias("roots")).where("roots > 1")
    tiles = lambda n: F.ceil(n / tile).cast("int")
    groups = scratch.save(groups.select("key", F.col("largest.root").alias("core"), tiles(F.col("n")).alias("tiles"), tiles(F.col("n") - F.col("largest.n")).alias("loose_tiles")))
    dealt = rooted.join(groups, "key").join(sets.select(F.col("set_id").alias("a"), "n_shingles", "sketch"), "a")
    own = lambda n: F.pmod(F.xxhash64("a"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["key", "a", "root", "n_shingles", "sketch"]
    left = dealt.where(F.col("root") != F.col("core")).select(*columns, F.lit(True).alias("loose"), own("loose_tiles").alias("i"), every("tiles").alias("j"))
    right = dealt.select(*columns, F.lit(False).alias("loose"), every("loose_tiles").alias("i"), own("tiles").alias("j"))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("n_shingles", kind="stable")
        sketches = [np.frombuffer(x, U) for x in frame["sketch"]]
        width = min(map(len, sketches))
        table, loose = np.concatenate([fold(s[None], width) for s in sketches]), frame["loose"].to_numpy(bool)
        n, root, names = (frame[c].to_numpy() for c in ("n_shingles", "root", "a"))
        others = np.flatnonzero(~loose)
        sizes, out = n[others], [np.empty((2, 0), np.int64)]
        for x in np.flatnonzero(loose):
            # Sizes ascend: the partners of x have 3/4 to 4/3 of its size.
            y = others[np.searchsorted(sizes, -(-3 * n[x] // 4), "left") : np.searchsorted(sizes, n[x] * 4 // 3, "right")]
            y = y[root[y] != root[x]]
            if len(y):
                apart = np.bitwise_count(table[y] ^ table[x]).sum(axis=1)
                out.append(np.stack([np.full(len(y), x), y])[:, apart <= (n[x] + n[y]) // 7])
        found = np.concatenate(out, axis=1)
        a, b = names[found[0]], names[found[1]]
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return left.union(right).groupBy("key", "i", "j").applyInPandas(compare, "a bigint, b bigint").distinct()


def row_key(df: DataFrame) -> Column:
    """A hash of all columns but maps: rows that agree in it are taken to be equal."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()])


def jaccard_components(docs: DataFrame, scratch: Scratch, sample: int = SAMPLE, tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """(doc_id, row, n_shingles, set_id) of every row, and (set_id, root) of the sets that have a link, as written tables.

    ``row`` is the row's ``row_key``. Sets are known by 64 bits. A null text is empty; a document without words has no set and no
    link. Rows that repeat a doc_id are documents of their own that share an id. Other columns may have any names.
    """
    text = docs.select("doc_id", row_key(docs).alias("row"), "text")
    members = scratch.save(document_sets(text, sample))
    found = hot_parts(members)
    table = docs.sparkSession.sparkContext.broadcast(found) if found is not None else None
    members = members.drop("parts")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(6, math.ceil(total / BUCKET_BYTES))
    grouped = _packed(docs, buckets, table).groupBy("bucket")
    schema = "kind int, a bigint, b bigint, times bigint, need bigint, info bigint"
    found = scratch.save(grouped.applyInPandas(lambda key, frame: _agreeing(key[0], frame), schema))
    if table is not None:
        table.destroy()  # else every Python worker keeps it

    pairs = scratch.save(found.where("kind = 0").groupBy("a", "b").agg(F.sum("times").alias("times"), F.max("need").alias("need")))
    posts = scratch.save(found.where("kind = 1").select("a", F.col("b").alias("key"), "info").distinct())
    parts = scratch.save(posts.groupBy("a", "info").agg(F.count("*").alias("parts")).groupBy("a").agg(F.max("parts").alias("parts")))
    # A pair may also share hot parts, at most as many as either has.
    weak = pairs.where("times < need")
    for side in "ab":
        weak = weak.join(parts.select(F.col("a").alias(side), "parts"), side).where("parts >= need - times").drop("parts")
    hot = _hot_postings(posts, scratch)
    size = F.floor(F.col("info") / 4)
    # Of the sets of a group the one with the most hot parts: what the others are copies of has all of them.
    # Written, so that the join with a key of many sets is one of plain shuffles, which can be split.
    hubs = scratch.save(hot.groupBy("key").agg(F.min(F.struct((-F.col("parts")).alias("rank"), "a", size.alias("n"))).alias("hub")))
    star = hot.join(hubs, "key").where((F.col("hub.a") != F.col("a")) & (F.least("hub.n", size) * 4 >= F.greatest("hub.n", size) * 3))
    star = star.select(F.col("hub.a").alias("x"), F.col("a").alias("y")).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    pairs = scratch.save(pairs.where("times >= need").select("a", "b").union(weak.select("a", "b")).union(star).distinct())

    wanted = pairs.select("a").union(pairs.select("b")).union(hot.select("a")).distinct()
    # One row of each set by its key: rows of one id, or without an id, do not meet.
    wanted = members.join(wanted, members["set_id"] == wanted["a"]).groupBy("set_id").agg(F.min("row").alias("row"))
    wanted = text.join(wanted, "row").select("text", F.col("set_id").alias("wanted"))

    def full(texts: list[str | None]) -> list:
        sets = list(shingle_sets(texts))
        return [[set_id(s) if len(s) else None for s in sets], [len(s) for s in sets], [s.tobytes() for s in sets], [bit_sketch(s) for s in sets]]

    sets = map_texts(wanted, full, "set_id bigint, n_shingles bigint, shingles binary, sketch binary")
    sets = scratch.save(sets.where("set_id = wanted").drop("wanted").dropDuplicates(["set_id"]))
    links = scratch.save(_verified(pairs, sets))
    roots = components(links, scratch)
    if not hot.isEmpty():
        more = scratch.save(_verified(_across(hot, roots, sets, scratch, tile), sets))
        if not more.isEmpty():
            roots = components(links.union(more), scratch)
    return members, scratch.save(roots.select(F.col("node").alias("set_id"), "root"))


def component_ids(docs: DataFrame, scratch: Scratch, sample: int = SAMPLE, tile: int = TILE) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: the smallest doc_id that links reach, the own one without links."""
    members, roots = jaccard_components(docs, scratch, sample, tile)
    rooted = members.join(roots, "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    least = rooted.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    return rooted.join(least, "root", "left").select(
        "doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id")
    )


def one_of_each(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row of the smallest doc_id, then of the smallest ``row_key``.

    Documents without words have no copies and all stay. A null doc_id comes after all others; of equal rows one stays. The rows that stay
    are found on ids and keys alone; then every row with words crosses one shuffle, to its key.
    """
    members, roots = jaccard_components(docs, scratch)
    worded = members.where("set_id is not null")
    rooted = worded.join(roots, "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    stay = rooted.groupBy("root").agg(first).select(F.col("first.row").alias("_row"))
    copies = worded.groupBy(F.col("row").alias("_row")).agg(F.count("*").alias("copies")).where("copies > 1")
    stay = scratch.save(stay.join(copies, "_row", "left").select("_row", F.col("copies").isNotNull().alias("again")))
    has_word = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_whole"), row_key(docs).alias("_row"), has_word.alias("_worded"))
    keyed = rows.where("_worded")
    kept = rows.where("not _worded").select("_whole").union(keyed.join(stay.where("not again"), "_row", "left_semi").select("_whole"))
    again = stay.where("again")
    if not again.isEmpty():
        kept = kept.union(keyed.join(again, "_row", "left_semi").dropDuplicates(["_row"]).select("_whole"))
    return kept.select(*[F.col(f"_whole.`{c}`").alias(c) for c in docs.columns])
