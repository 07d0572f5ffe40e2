"""N-gram Jaccard join: clusters of documents whose sets of word shingles overlap by a given share.

Grouped prefix join. The shingles of all documents have one order: those not known as frequent by hash, then
the frequent ones, rarest first. Two sets that overlap enough share a shingle among the first ones of each,
their prefixes. Equal sets are one class, and classes of equal prefix and size are one group. Groups
that share a prefix shingle and whose sizes fit are candidates; their classes are compared exactly.

What is frequent is counted over all documents, first among the shingles of least hash, then where a prefix
moves on because of those found. Any set of frequent shingles gives right results; more of
them make smaller buckets. No more than ``FREQUENT`` of them are held, the most frequent ones. A shingle that
has many groups and was not found so is treated as a frequent one.

A pair of groups is dropped if the parts of their prefixes that are complete in both miss more shingles of each other
than sets of these sizes may.

Clusters need not every link. First each bucket is linked to one of its groups, and each group to one of its
classes. The clusters so found answer for nearly all pairs; only pairs of a bucket that lie in different
clusters are then compared, all of them. A large group of near copies so costs as many comparisons as it has
members, and no link between two clusters is lost.

Rules: a text without words, null or empty, has no shingles and is linked with nothing; fewer words than a
shingle has are one shingle; repeated rows are equal sets; rows without an id are clustered too, a cluster of those
alone has a null ``component_id``; very long texts are one batch of their own; other columns are ignored; an empty
table gives no rows. The 64-bit hash of a shingle stands for it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recflow.llm.common import map_batches, parts, raw
from recflow.llm.components import components
from recflow.operators.joins import lookup
from recflow.session import materialize

WORDS = 5
PERCENT = 80
# A shingle in the counted part of so many documents is frequent; most of them that are held.
OFTEN = 32
FREQUENT = 1 << 18
ROUNDS = 2
# Documents and groups to compare that are looked up by a broadcast of their ids, at most.
LOOKED_UP = 1 << 20

MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[1])
    return x ^ (x >> np.uint64(31))


def _weights(words: int) -> np.ndarray:
    """An odd factor for each place in a shingle."""
    return _mixed(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(texts: list[bytes | None], words: int) -> list[np.ndarray]:
    """The distinct shingle hashes of every text, ascending."""
    found = [(t or b"").lower().split() for t in texts]
    sizes = np.array([len(f) for f in found], np.int64)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(w) for f in found for w in f), np.uint64, int(sizes.sum()))
    total = max(0, len(hashes) - words + 1)
    weights = _weights(words)
    shingles = np.zeros(total, np.uint64)
    for i, weight in enumerate(weights):
        shingles += hashes[i : i + total] * weight
    shingles = _mixed(shingles)
    out, start = [], 0
    for size in sizes.tolist():
        if size >= words:
            out.append(np.unique(shingles[start : start + size - words + 1]))
        elif size:
            whole = (hashes[start : start + size] * weights[:size]).sum(dtype=np.uint64) + np.uint64(size)
            out.append(_mixed(np.array([whole], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
        start += size
    return out


class Frequent:
    """The frequent shingles so far: in which round each was found, and its rank from the rarest."""

    def __init__(self, rounds: list[np.ndarray], ranks: list[np.ndarray]):
        values = np.concatenate(rounds) if rounds else np.zeros(0, np.uint64)
        found_in = np.repeat(np.arange(len(rounds)), [len(r) for r in rounds])
        order = np.argsort(values, kind="stable")
        self.values, self.found_in = values[order], found_in[order]
        self.rank = (np.concatenate(ranks) if ranks else np.zeros(0, np.int64))[order]
        self.rounds = len(rounds)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.values >> np.uint64(44)] = True

    def find(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``shingles`` of frequent ones, and their places here."""
        at = np.flatnonzero(self.maybe[shingles >> np.uint64(44)])
        here = np.minimum(np.searchsorted(self.values, shingles[at]), max(0, len(self.values) - 1))
        same = self.values[here] == shingles[at] if len(self.values) else np.zeros(len(at), bool)
        return at[same], here[same]


def prefix_size(n: int, percent: int) -> int:
    """How many first shingles of a set of ``n`` any set similar enough must meet."""
    return n - -(-n * percent // 100) + 1 if n else 0


def windows(shingles: np.ndarray, frequent: Frequent, percent: int) -> tuple[int, int]:
    """The beginning of a set that was counted before this round, and after it.

    A round goes on to the place at which the prefix is full without the frequent shingles known, and as far again;
    to the end where many are frequent, as the rest of such a text will be.
    """
    size = prefix_size(len(shingles), percent)
    before, now = 0, size
    at, here = frequent.find(shingles) if frequent.rounds else (np.zeros(0, int),) * 2
    for number in range(frequent.rounds):
        before = now
        plain = np.ones(len(shingles), bool)
        plain[at[frequent.found_in[here] <= number]] = False
        full = np.flatnonzero(plain)[size - 1 : size]
        need = int(full[0]) + 1 if len(full) else len(shingles)
        if need > now:
            now = min(len(shingles), 2 * need - size) if 4 * (need - size) < size else len(shingles)
    return before, now


def prefix(shingles: np.ndarray, frequent: Frequent, percent: int) -> tuple[np.ndarray, int]:
    """The first shingles of a set, and how many of them are not frequent."""
    size = prefix_size(len(shingles), percent)
    at, here = frequent.find(shingles)
    if not len(at):
        return shingles[:size], size
    plain = np.delete(shingles, at)[:size]
    rest = shingles[at][np.argsort(frequent.rank[here], kind="stable")]
    return np.concatenate([plain, rest[: size - len(plain)]]), len(plain)


def _counted(words: int, percent: int, known: object) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = Frequent(*known.value)
        for batch in batches:
            for part in parts([batch]):
                out = [np.zeros(0, np.uint64)]
                for shingles in shingle_sets(raw(part), words):
                    before, now = windows(shingles, frequent, percent)
                    out.append(shingles[before:now])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out).view(np.int64))], ["shingle"])

    return run


Rounds = tuple[list[np.ndarray], list[np.ndarray]]


def frequent_shingles(docs: DataFrame, words: int, percent: int, often: int) -> Rounds:
    """The arguments of ``Frequent``, counted over all documents."""
    context = docs.sparkSession.sparkContext
    rounds, ranks, held = [], [], 0
    while held < FREQUENT and len(rounds) < ROUNDS:
        known = context.broadcast((rounds, ranks))
        shingles = map_batches(docs.select("text"), _counted(words, percent, known), "shingle bigint")
        counts = shingles.groupBy("shingle").agg(F.count("*").alias("n")).where(F.col("n") >= often)
        found = counts.orderBy(F.desc("n"), "shingle").limit(FREQUENT - held).toArrow()
        if not found.num_rows:
            break
        values = found.column("shingle").to_numpy().view(np.uint64)
        new = np.flatnonzero(~np.isin(values, np.concatenate(rounds))) if rounds else np.arange(len(values))
        rounds.append(values[new])
        ranks.append(found.column("n").to_numpy()[new].astype(np.int64))
        held += len(new)
    return rounds, ranks


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _sets(words: int, percent: int, known: object) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The class, the group and the prefix of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = Frequent(*known.value)
        for batch in batches:
            for part in parts([batch]):
                sets = shingle_sets(raw(part), words)
                first = [prefix(s, frequent, percent) for s in sets]
                classes = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                groups = [xxhash.xxh3_64_intdigest(p.tobytes(), len(s)) for s, (p, _) in zip(sets, first)]
                ends = np.cumsum([0, *(len(p) for p, _ in first)], dtype=np.int32)
                values = np.concatenate([np.zeros(0, np.uint64), *(p for p, _ in first)])
                columns = [
                    part.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(classes, pa.binary()),
                    _signed(np.array(groups, np.uint64)),
                    pa.array([plain for _, plain in first], pa.int32()),
                    pa.ListArray.from_arrays(pa.array(ends), _signed(values)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "class", "grp", "plain", "prefix"])

    return run


def _buckets(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The distinct groups of every shingle that more than one group has; rows come sorted by shingle and group.

    More than ``most`` groups of a shingle come as pieces of that many, with the shingle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, long, groups, sizes = None, False, [], []
        out: list[tuple] = []

        def end(whole: bool) -> None:
            nonlocal groups, sizes
            if len(groups) > 1 or long:
                out.append((now if long or not whole else None, groups, sizes))
            groups, sizes = [], []

        def record() -> pa.RecordBatch:
            types = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            arrays = [pa.array([r[i] for r in out], t) for i, t in enumerate(types)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, ["shingle", "groups", "sizes"])

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            shingle, group, n = (batch.column(c).to_numpy() for c in ("shingle", "grp", "n"))
            # shingles that one row alone has are most of them
            same = np.r_[shingle[0] == last, shingle[1:] == shingle[:-1]]
            last = shingle[-1]
            follow = same | np.r_[same[1:], True]
            for s, g, size in zip(shingle[follow].tolist(), group[follow].tolist(), n[follow].tolist()):
                if s != now:
                    end(True)
                    now, long = s, False
                elif groups and groups[-1] == g:
                    continue
                elif len(groups) >= most:
                    long, before = True, groups[-1]
                    end(False)
                    if before == g:
                        continue
                groups.append(g)
                sizes.append(size)
            yield record()
        end(True)
        yield record()

    return run


def _likely(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The pairs of groups that their prefixes allow.

    The plain part of a prefix has all plain shingles of the set up to its last one, and all of them if the prefix
    goes on with frequent ones. Up to the lesser end both sets are known, and there neither may have more
    shingles that the other lacks than sets of these sizes with enough in common.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("an", "ap", "bn", "bp")]
            arrays = [batch.column(c) for c in ("as", "bs")]
            kept = []
            for an, ap, bn, bp, a, b in zip(*columns, *arrays):
                a, b = a.values.to_numpy().view(np.uint64), b.values.to_numpy().view(np.uint64)
                ends = [s[p - 1] for s, p in ((a, ap), (b, bp)) if p and p == len(s)]
                a, b = a[:ap], b[:bp]
                if ends:
                    a, b = a[a <= min(ends)], b[b <= min(ends)]
                common = len(np.intersect1d(a, b, assume_unique=True))
                least = -(-(an + bn) * percent // (100 + percent))
                kept.append(len(a) - common <= an - least and len(b) - common <= bn - least)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return run


def _fits(a: Column, b: Column, percent: int) -> Column:
    """Whether sets of these sizes can overlap enough."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _looked_up(table: DataFrame, asked: DataFrame, key: str) -> DataFrame:
    """The rows of a table whose key is asked for, null keys too, with the other columns of ``asked``."""
    if asked.count() <= LOOKED_UP:
        asked = F.broadcast(asked)
    joined = table.join(asked.withColumnRenamed(key, "_asked"), F.col(key).eqNullSafe(F.col("_asked")))
    return joined.drop("_asked")


def _meet(a: Column, n: Column, b: Column, m: Column, percent: int) -> Column:
    """Whether a shingle at these places can be the first one that two similar sets of these sizes share."""
    least = F.ceil((n + m) * percent / (100 + percent))
    return _fits(n, m, percent) & (a <= n - least) & (b <= m - least)


class Join:
    """The tables of one join: ``docs`` rows with class and group, ``classes``, buckets of groups."""

    def __init__(self, docs: DataFrame, words: int, percent: int, often: int):
        self.docs, self.words, self.percent = docs.select("doc_id", "text"), words, percent
        context = docs.sparkSession.sparkContext
        known = context.broadcast(frequent_shingles(docs, words, percent, often))
        kind = docs.schema["doc_id"].dataType.simpleString()
        schema = f"doc_id {kind}, n bigint, class binary, grp bigint, plain int, prefix array<bigint>"
        self.rows = materialize(map_batches(self.docs, _sets(words, percent, known), schema), "shingle-sets")
        named = self.rows.where(F.col("class").isNotNull())
        self.classes = materialize(
            named.groupBy("class").agg(F.min("doc_id").alias("doc_id"), F.first("grp").alias("grp"), F.first("n").alias("n")),
            "classes",
        )
        shingles = named.select("grp", "n", "plain", F.posexplode("prefix").alias("place", "shingle"))
        plain = shingles.where(F.col("place") < F.col("plain")).select("shingle", "grp", "n")
        plain = plain.repartition("shingle").sortWithinPartitions("shingle", "grp")
        found = map_batches(plain, _buckets(4 * often), "shingle bigint, groups array<bigint>, sizes array<bigint>")
        found = materialize(found, "shared-shingles")
        # shingles that the same groups share make one bucket
        lists = found.where(F.col("shingle").isNull()).groupBy("groups").agg(F.first("sizes").alias("sizes"))
        self.lists = materialize(lists.withColumn("bucket", F.monotonically_increasing_id()), "buckets")
        hot = shingles.where(F.col("place") >= F.col("plain")).select("shingle", "grp", "n", "place")
        long = found.where(F.col("shingle").isNotNull()).select("shingle", F.inline(F.arrays_zip("groups", "sizes")))
        hot = hot.union(long.select("*", F.lit(0)))
        self.hot = materialize(hot.groupBy("shingle", "grp", "n").agg(F.min("place").alias("place")), "frequent-buckets")

    def likely(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of groups that pass the test of their prefixes."""
        pairs = materialize(pairs.distinct(), "group-pairs")
        asked = pairs.select(F.col("a").alias("grp")).union(pairs.select("b")).distinct()
        side = _looked_up(self.rows.select("grp", "n", "plain", "prefix"), materialize(asked, "asked-groups"), "grp")
        side = materialize(side.groupBy("grp").agg(*[F.first(c).alias(c) for c in ("n", "plain", "prefix")]), "prefixes")
        both = lookup(pairs, side.toDF("a", "an", "ap", "as"), ["a"])
        both = lookup(both, side.toDF("b", "bn", "bp", "bs"), ["b"])
        return map_batches(both, _likely(self.percent), "a bigint, b bigint")

    def leaders(self) -> DataFrame:
        """One class of every group."""
        return self.classes.groupBy("grp").agg(F.min("class").alias("class"))

    def stars(self) -> DataFrame:
        """Pairs (x, y) of classes: each bucket about one group, each group about one class."""
        pairs = self.lists.select(
            F.col("groups")[0].alias("b"), F.col("sizes")[0].alias("m"), F.inline(F.arrays_zip("groups", "sizes"))
        ).toDF("b", "m", "a", "n")
        # frequent shingles stand earliest in the set that has fewest others, as the source of copies has
        middle = F.min(F.struct("place", "n", "grp")).alias("middle")
        middles = materialize(self.hot.groupBy("shingle").agg(middle), "middles")
        around = lookup(self.hot, middles, ["shingle"])
        meet = _meet(F.col("place"), F.col("n"), F.col("middle.place"), F.col("middle.n"), self.percent)
        around = around.where(meet).select(
            F.col("middle.grp").alias("b"), F.col("middle.n").alias("m"), F.col("grp").alias("a"), "n"
        )
        pairs = pairs.union(around).where((F.col("a") != F.col("b")) & _fits(F.col("n"), F.col("m"), self.percent))
        leaders = materialize(self.leaders(), "leaders")
        between = lookup(self.likely(pairs.select("a", "b")), leaders.toDF("a", "x"), ["a"])
        between = lookup(between, leaders.toDF("b", "y"), ["b"]).select("x", "y")
        inside = lookup(self.classes.select("grp", F.col("class").alias("x")), leaders.toDF("grp", "y"), ["grp"])
        return between.union(inside.where(F.col("x") != F.col("y")).select("x", "y"))

    def rest(self, clusters: DataFrame) -> DataFrame:
        """Pairs of classes of one bucket or group that lie in different clusters, from (class, grp, n, root)."""
        span = [F.min("root").alias("low"), F.max("root").alias("high")]
        groups = materialize(clusters.groupBy("grp").agg(*span), "group-clusters")
        members = self.lists.select("bucket", F.inline(F.arrays_zip("groups", "sizes"))).toDF("bucket", "grp", "n")
        member = F.struct("grp", "n", "low", "high")
        mixed = (
            lookup(members, groups, ["grp"])
            .groupBy("bucket")
            .agg(F.collect_list(member).alias("members"), F.min("low").alias("low"), F.max("high").alias("high"))
            .where(F.col("low") != F.col("high"))
        )
        apart = lambda a, b: (a["low"] != b["low"]) | (a["low"] != a["high"]) | (b["low"] != b["high"])
        partners = lambda a: F.filter(
            "members", lambda b: (b["grp"] > a["grp"]) & apart(a, b) & _fits(a["n"], b["n"], self.percent)
        )
        stars = F.transform("members", lambda a: F.struct(a["grp"].alias("a"), partners(a)["grp"].alias("others")))
        few = mixed.select(F.inline(stars)).select("a", F.explode("others").alias("b"))

        # in a frequent bucket of several clusters, all groups meet those outside the largest cluster
        hot = lookup(self.hot, groups, ["grp"])
        spans = hot.groupBy("shingle").agg(F.min("low").alias("l"), F.max("high").alias("h")).where(F.col("l") != F.col("h"))
        hot = materialize(lookup(hot, materialize(spans.select("shingle"), "mixed"), ["shingle"]), "mixed-buckets")
        sizes = hot.groupBy("shingle", "low").agg(F.count("*").alias("c"))
        main = materialize(sizes.groupBy("shingle").agg(F.max_by("low", "c").alias("main")), "main-clusters")
        strays = lookup(hot, main, ["shingle"]).where((F.col("low") != F.col("main")) | (F.col("low") != F.col("high")))
        strays = strays.select("shingle", *[F.col(c).alias(f"_{c}") for c in ("grp", "n", "place", "low", "high")])
        one, two = ({c: F.col(p + c) for c in ("low", "high")} for p in ("", "_"))
        met = lookup(hot, strays, ["shingle"]).where(
            (F.col("grp") != F.col("_grp"))
            & apart(one, two)
            & _meet(F.col("place"), F.col("n"), F.col("_place"), F.col("_n"), self.percent)
        )
        many = met.select(F.least("grp", "_grp").alias("a"), F.greatest("grp", "_grp").alias("b"))
        inside = groups.where(F.col("low") != F.col("high")).select(F.col("grp").alias("a"), F.col("grp").alias("b"))
        pairs = self.likely(few.union(many)).union(inside)
        side = clusters.select("grp", "class", "root")
        met = lookup(pairs, side.toDF("a", "x", "xr"), ["a"])
        met = lookup(met, side.toDF("b", "y", "yr"), ["b"]).where(F.col("xr") != F.col("yr"))
        return met.where((F.col("a") != F.col("b")) | (F.col("x") < F.col("y"))).select("x", "y")

    def sets(self, classes: DataFrame) -> DataFrame:
        """(class, shingles) of some classes, from the text of one document of each."""
        asked = materialize(lookup(self.classes, classes, ["class"], "left_semi").select("class", "doc_id"), "asked")
        texts = _looked_up(self.docs, asked, "doc_id")
        words = self.words

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in parts([batch]):
                    wanted, sets = part.column("class").to_pylist(), shingle_sets(raw(part), words)
                    right = [xxhash.xxh3_128_digest(s.tobytes()) == c for s, c in zip(sets, wanted)]
                    sets = [s for s, r in zip(sets, right) if r]
                    ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
                    values = _signed(np.concatenate([np.zeros(0, np.uint64), *sets]))
                    columns = [pa.array([c for c, r in zip(wanted, right) if r], pa.binary())]
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), values))
                    yield pa.RecordBatch.from_arrays(columns, ["class", "shingles"])

        found = map_batches(texts.select("class", "text"), run, "class binary, shingles array<bigint>")
        return found.groupBy("class").agg(F.first("shingles").alias("shingles"))

    def linked(self, pairs: DataFrame) -> DataFrame:
        """Edges (u, v): the pairs (x, y) whose sets overlap enough, compared exactly."""
        pairs = materialize(pairs.distinct(), "pairs")
        asked = pairs.select(F.col("x").alias("class")).union(pairs.select("y")).distinct()
        sets = materialize(self.sets(asked), "compared-sets")
        both = lookup(pairs, sets.toDF("x", "xs"), ["x"])
        both = lookup(both, sets.toDF("y", "ys"), ["y"])
        common = F.size(F.array_intersect("xs", "ys"))
        enough = common * 100 >= (F.size("xs") + F.size("ys") - common) * self.percent
        return both.where(enough).select(F.col("x").alias("u"), F.col("y").alias("v"))

    def roots(self) -> DataFrame:
        """(class, doc_id, grp, n, root) of every class; classes that links connect have one root."""
        now = self.classes.withColumn("root", F.col("class"))
        for pairs in (lambda _: self.stars(), self.rest):
            edges = materialize(self.linked(pairs(now)), "links")
            named = now.select("class", "root")
            edges = lookup(edges, named.toDF("u", "ur"), ["u"])
            edges = lookup(edges, named.toDF("v", "vr"), ["v"]).select(F.col("ur").alias("u"), F.col("vr").alias("v"))
            found = components(edges).toDF("root", "top")
            joined = lookup(now, found, ["root"], "left").withColumn("root", F.coalesce("top", "root")).drop("top")
            now = materialize(joined, "clusters")
        return now


def clusters(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, often: int = OFTEN) -> DataFrame:
    """(doc_id, n_shingles, component_id): the smallest doc_id reachable over links, itself included.

    Two documents are linked when their shingle sets have ``percent`` of their union in common.
    """
    join = Join(docs, words, percent, often)
    found = join.roots()
    least = materialize(found.groupBy("root").agg(F.min("doc_id").alias("component_id")), "least")
    named = lookup(found.select("class", "root"), least, ["root"]).select("class", "component_id")
    rows = join.rows.select("doc_id", "n", "class")
    return lookup(rows, named, ["class"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
