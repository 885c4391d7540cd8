"""N-gram Jaccard join: which texts share at least ``percent`` per cent of their distinct word shingles.

Every different set is indexed under its rarest shingles, as many as any partner must meet (prefix filter). Index lists
hold ``(size, set, position)``. Two skips on set relations keep the lists cheap:

* lists are in blocks ordered by size and position; two blocks are skipped where no sizes and positions in them leave the
  needed overlap possible, and so is a pair, before it becomes a row;
* every set is first compared with the heads of its lists, the sets that meet the most others, and answers are derived from
  theirs: what links to a head is in its component and never compared within it again, and for two sets whose exact overlaps
  with one head are known, these bound their own overlap, so that only pairs that the bound leaves open are compared.

A group of many near copies meets few heads, as the text that they are copies of, or the closest to it, shares the most with
them; it stays linear in its size.

No pair at or above the threshold is lost: every linked pair ends in one component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.words import batches, lean, shingles, words
from pagemill.session import broadcast_if_small, written

#: The order of shingles needs to know the common ones only. At most so many are sent to the tasks; any choice of them
#: gives the same result.
MOST_COMMON = 1 << 20
#: A list of a shingle in 2^LIST_BITS or more texts is dealt over several rows.
LIST_BITS = 11

Common = tuple[np.ndarray, np.ndarray]


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """The distinct shingles of each text, sorted."""
    hashes, _, _, at = words(texts)
    every, bounds = shingles(hashes, at, k)
    return [np.unique(every[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def set_number(shingle_set: np.ndarray) -> int:
    """A set's number. With its size it tells sets apart: two of 10^10 sets of equal size collide once in 10^6 corpora or less often."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingle_set.tobytes())).view(np.int64))


def prefix_size(n: int, percent: int) -> int:
    """So many of a set's rarest shingles that any set linked to it holds one of them: ``n - ceil(percent n / 100) + 1``."""
    return n - (percent * n + 99) // 100 + 1 if n else 0


def common_shingles(docs: DataFrame, text: str, k: int, least: int = 16, most: int = MOST_COMMON) -> Common:
    """Common shingles with the binary order of their counts, over all texts.

    A task reports the shingles that it meets in three or more of the texts it holds at once; what it leaves out is rare
    there, and the order may take it for rare. Of the reported ones those from ``least`` up are kept, or from the next
    powers of two until at most ``most`` are left.
    """

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n = 0

        def flush() -> pa.RecordBatch:
            every = np.concatenate([*held, np.zeros(0, np.uint64)])
            held.clear()
            every.sort()
            first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
            count = np.diff(np.append(first, len(every)))
            often = count >= 3
            return pa.record_batch([pa.array(every[first[often]].view(np.int64)), pa.array(count[often])], ["shingle", "n"])

        for part in lean(parts):
            for a, b in batches(part.column(0)):
                sets = shingle_sets(part.column(0).slice(a, b - a), k)
                held += sets
                n += sum(map(len, sets))
                if n >= 3_000_000:
                    yield flush()
                    n = 0
        yield flush()

    counts = docs.select(text).mapInArrow(counted, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    counts = written(counts.select("shingle", F.floor(F.log2("n") + 1e-9).cast("int").alias("order")), "common-shingles")
    orders = sorted(counts.groupBy("order").count().collect(), reverse=True)  # at most 64 rows
    floor, total = 64, 0
    for order, n in orders:
        total += n
        if total > most:
            break
        floor = order
    table = counts.filter(F.col("order") >= floor).toPandas()
    shingle = table["shingle"].to_numpy(np.int64).view(np.uint64)
    rank = np.argsort(shingle)
    return shingle[rank], table["order"].to_numpy(np.uint8)[rank]


def signature(shingle_set: np.ndarray, common: Common, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The set's rarest shingles, in the order that all sets share, and the binary order of their counts (0: not common)."""
    known, orders = common
    order = np.zeros(len(shingle_set), np.uint8)
    if len(known):
        at = np.minimum(np.searchsorted(known, shingle_set), len(known) - 1)
        hit = known[at] == shingle_set
        order[hit] = orders[at[hit]]
    rank = np.argsort(order, kind="stable")[: prefix_size(len(shingle_set), percent)]
    return shingle_set[rank], order[rank]


def signatures(docs: DataFrame, key: str, text: str, k: int, percent: int, common: Common) -> DataFrame:
    """Per text: id, n (set size), set (its number), prefix and order (see ``signature``)."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def signed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in lean(parts):
            for a, b in batches(part.column(1)):
                sets = shingle_sets(part.column(1).slice(a, b - a), k)
                rare = [signature(s, shared.value, percent) for s in sets]
                yield pa.record_batch(
                    [
                        part.column(0).slice(a, b - a),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([set_number(s) for s in sets], pa.int64()),
                        pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(x) for x, _ in rare])]).astype(np.int32), np.concatenate([x for x, _ in rare]).view(np.int64)),
                        pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(x) for x, _ in rare])]).astype(np.int32), np.concatenate([o for _, o in rare]).astype(np.int8)),
                    ],
                    ["id", "n", "set", "prefix", "order"],
                )

    return docs.select(F.col(key).cast("long").alias("id"), text).mapInArrow(signed, "id long, n long, set long, prefix array<long>, order array<byte>")


def index_lists(signed: DataFrame) -> DataFrame:
    """Lists ``shingle, chunk, members`` (n, set, position) of all shingles that more than one set is indexed under.

    The index knows a shingle by 40 bits: a rare chance meeting costs a comparison and changes no answer.
    """
    entry = signed.select("n", "set", F.posexplode(F.arrays_zip("prefix", "order")).alias("position", "entry"))
    order = F.col("entry.order").cast("int")
    chunk = F.when(order >= LIST_BITS, F.expr(f"pmod(set, shiftleft(1L, cast(entry.order as int) - {LIST_BITS - 1})) + 1")).otherwise(0)
    place = F.shiftleft(F.col("n"), 32) + F.col("position")
    rows = entry.select(F.shiftrightunsigned(F.col("entry.prefix"), 24).alias("shingle"), chunk.cast("int").alias("chunk"), "set", place.alias("place"))
    dealt = rows.repartition("shingle", "chunk")  # long lists are in chunks of bounded size
    lists = dealt.groupBy("shingle", "chunk").agg(F.collect_set(F.struct("place", "set")).alias("members"))
    lists = lists.filter((F.size("members") > 1) | (F.col("chunk") > 0))
    members = F.transform("members", lambda m: F.struct(F.shiftright(m["place"], 32).alias("n"), m["set"].alias("set"), m["place"].bitwiseAND(0xFFFFFFFF).alias("position")))
    return lists.select("shingle", "chunk", members.alias("members"))


def meetings(lists: DataFrame) -> DataFrame:
    """``set, degree``: with how many others a set meets, summed over its lists; a rough measure of how central it is."""
    return lists.select(F.explode("members.set").alias("set"), F.size("members").alias("size")).groupBy("set").agg(F.sum("size").alias("degree"))


def with_state(lists: DataFrame, state: DataFrame) -> DataFrame:
    """The lists with what is known of each member: degree, label of its component, and head with the overlap (``shared``).

    Lists whose members are all in one component drop out, as do chunks of one list that together have only one. Members
    are ordered by degree, the most central first.
    """
    member = lists.select("shingle", "chunk", F.explode("members").alias("m")).select("shingle", "chunk", "m.n", "m.set", "m.position")
    known = member.join(state, "set", "left").withColumn("label", F.coalesce("label", "set"))
    entry = F.struct((-F.coalesce("degree", F.lit(0))).alias("less"), F.xxhash64("set").alias("hash"), "n", "set", "position", "label", "head", "shared")
    lists = known.groupBy("shingle", "chunk").agg(F.sort_array(F.collect_list(entry)).alias("members"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    lists = written(lists.filter("chunk > 0 or lo <> hi"), "open-lists")
    chunks = lists.filter("chunk > 0")
    several = chunks.groupBy("shingle").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter("lo <> hi").select("shingle")
    return lists.filter("chunk = 0").union(chunks.join(several, "shingle", "left_semi")).select("shingle", "chunk", "members")


def may_link(a: Column, b: Column, percent: int) -> Column:
    """Whether two list members can reach the needed overlap by their sizes, positions and overlaps with a common head."""
    small, large = F.least(a["n"], b["n"]), F.greatest(a["n"], b["n"])
    left = F.least(a["n"] - a["position"], b["n"] - b["position"])
    derived = F.least(a["shared"], b["shared"]) + F.least(a["n"] - a["shared"], b["n"] - b["shared"])
    most = F.when(a["head"] == b["head"], F.least(left, derived)).otherwise(left)
    return (100 * small >= percent * large) & ((100 + percent) * most >= percent * (small + large))


def pair(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def head_pairs(lists: DataFrame, percent: int, heads: int, central: bool) -> DataFrame:
    """``a, b, head``: the members of every list with its heads: the most central ones, or some by a hash.

    The order of heads is the same in all lists, so that a set meets few. Of a group whose centre has united most, the
    others are met with heads anywhere in it: only what is not yet in their component is compared. The chunks of a long
    list also share one head, the first of theirs, so that they become one component.
    """
    if not central:
        mixed = F.transform("members", lambda m: F.struct(m["hash"].alias("hash"), m["n"].alias("n"), m["set"].alias("set"), m["position"].alias("position"), m["label"].alias("label"), m["head"].alias("head"), m["shared"].alias("shared")))
        lists = lists.withColumn("members", F.sort_array(mixed))
    dealt = lists.filter("chunk > 0")
    shared = dealt.select("shingle", F.get("members", F.lit(0)).alias("top")).groupBy("shingle").agg(F.min("top").alias("top"))
    dealt = dealt.join(shared, "shingle", "left")
    lists = lists.filter("chunk = 0").withColumn("top", F.lit(None)).unionByName(dealt)
    some = F.filter(F.array_distinct(F.concat(F.slice("members", 1, heads), F.array("top"))), lambda m: m.isNotNull())
    asked = F.transform(
        some, lambda h: F.transform(F.filter("members", lambda m: (m["label"] != h["label"]) & may_link(h, m, percent)), lambda m: F.struct(*pair(h["set"], m["set"]), h["set"].alias("head")))
    )
    return lists.select(F.explode(F.flatten(asked)).alias("p")).select("p.*").groupBy("a", "b").agg(F.min("head").alias("head"))


def blocks(lists: DataFrame, size: int = 64) -> DataFrame:
    """``shingle, no, few, many, at, block``: members in order of size and position, ``size`` of them together.

    ``few`` and ``many`` are the bounds of their sizes, ``at`` is their smallest position. A list's chunks number their
    blocks apart.
    """
    members = F.transform("members", lambda m: F.struct("shingle", m["n"].alias("n"), m["position"].alias("position"), m["set"].alias("set"), m["label"].alias("label"), m["head"].alias("head"), m["shared"].alias("shared")).dropFields("shingle"))
    ordered = lists.select("shingle", "chunk", F.sort_array(members).alias("members"))
    starts = F.sequence(F.lit(0), F.floor((F.size("members") - 1) / size).cast("int"))
    cut = ordered.select("shingle", "chunk", "members", F.explode(starts).alias("part"))
    block = F.slice("members", F.col("part") * size + 1, size)
    no = F.shiftleft(F.col("chunk").cast("long"), 32) + F.col("part")
    return cut.select("shingle", no.alias("no"), block.alias("block")).selectExpr("shingle", "no", "block[0].n few", "block[size(block) - 1].n many", "array_min(block.position) at", "block")


def open_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """All pairs of list members in different components that no bound rules out; blocks meet, and only such pairs become rows."""
    cut = written(blocks(lists), "list-blocks")
    x, y = cut.alias("x"), cut.alias("y")
    need = percent * (F.col("x.few") + F.col("y.few"))
    left = F.least(F.col("x.many") - F.col("x.at"), F.col("y.many") - F.col("y.at"))
    near = (100 * F.col("x.many") >= percent * F.col("y.few")) & (100 * F.col("y.many") >= percent * F.col("x.few")) & ((100 + percent) * left >= need)
    met = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.no") <= F.col("y.no")) & near)
    once = lambda a, b: (a["label"] != b["label"]) & ((F.col("x.no") < F.col("y.no")) | (a["set"] < b["set"]))
    found = F.transform(F.col("x.block"), lambda a: F.transform(F.filter(F.col("y.block"), lambda b: once(a, b) & may_link(a, b, percent)), lambda b: F.struct(*pair(a["set"], b["set"]))))
    return met.select(F.explode(F.flatten(found)).alias("p")).select("p.*").distinct()


def _overlap(x: np.ndarray, y: np.ndarray) -> int:
    return len(np.intersect1d(x, y, assume_unique=True))


def within_reach(pairs: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """The pairs whose prefixes leave the needed overlap possible.

    Up to the earlier of the two last shingles both prefixes are complete: what they share there, and all that comes
    behind on the shorter side, bounds the overlap.
    """

    def bounded(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in lean(parts):
            a, b, n, m, p, q, o, r = (part.column(i) for i in range(8))
            sizes = zip(n.to_numpy(), m.to_numpy(), strict=True)
            keep = [
                (100 + percent) * _bound(int(size), int(other), *(x[i].values.to_numpy() for x in (p, q, o, r))) >= percent * (int(size) + int(other))
                for i, (size, other) in enumerate(sizes)
            ]
            yield pa.record_batch([a, b], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    ends = written(pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct(), "ends")
    signed = signed.join(broadcast_if_small(ends), "set").dropDuplicates(["set"])
    one = signed.select(F.col("set").alias("a"), F.col("n").alias("n"), F.col("prefix").alias("p"), F.col("order").alias("o"))
    two = signed.select(F.col("set").alias("b"), F.col("n").alias("m"), F.col("prefix").alias("q"), F.col("order").alias("r"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "n", "m", "p", "q", "o", "r").mapInArrow(bounded, "a long, b long")


def _bound(n: int, m: int, p: np.ndarray, q: np.ndarray, o: np.ndarray, r: np.ndarray) -> int:
    p, q = p.view(np.uint64), q.view(np.uint64)
    last = min((int(o[-1]), int(p[-1])), (int(r[-1]), int(q[-1])))
    known = [x[(k < last[0]) | (k == last[0]) & (x <= np.uint64(last[1]))] for x, k in ((p, o), (q, r))]
    return _overlap(*known) + min(n - len(known[0]), m - len(known[1]))


def sets_of(docs: DataFrame, key: str, text: str, k: int, wanted: DataFrame) -> DataFrame:
    """``set, shingles`` (sorted, 8 bytes each) of ``wanted`` sets, from the text of the document ``least`` of each."""

    def found(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in lean(parts):
            for a, b in batches(part.column(1)):
                own = [(x, s) for x, s in zip(part.column(0).slice(a, b - a).to_pylist(), shingle_sets(part.column(1).slice(a, b - a), k), strict=True) if set_number(s) == x]
                yield pa.record_batch([pa.array([x for x, _ in own], pa.int64()), pa.array([s.tobytes() for _, s in own], pa.binary())], ["set", "shingles"])

    wanted = wanted.select("set", F.col("least").alias("of"))
    known = docs.filter(F.col(key).isNotNull()).join(broadcast_if_small(wanted.filter("of is not null")), F.col(key).cast("long") == F.col("of"))
    rows = known.select("set", text).mapInArrow(found, "set long, shingles binary")
    unnamed = wanted.filter("of is null").select("set")
    if unnamed.isEmpty():
        return rows

    def numbered(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in lean(parts):
            for a, b in batches(part.column(0)):
                sets = {set_number(s): s for s in shingle_sets(part.column(0).slice(a, b - a), k)}
                yield pa.record_batch([pa.array(list(sets), pa.int64()), pa.array([s.tobytes() for s in sets.values()], pa.binary())], ["set", "shingles"])

    others = docs.filter(F.col(key).isNull()).select(text).mapInArrow(numbered, "set long, shingles binary")
    return rows.union(others.join(unnamed, "set", "left_semi").dropDuplicates(["set"]))


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, n, m, shared``: sizes and overlap of the pairs, from the whole sets."""

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in lean(parts):
            x, y = part.column(2), part.column(3)
            sizes = []
            for i in range(len(part)):
                one, two = np.frombuffer(x[i].as_buffer(), np.uint64), np.frombuffer(y[i].as_buffer(), np.uint64)
                sizes.append((len(one), len(two), _overlap(one, two)))
            sizes = np.array(sizes, np.int64).reshape(-1, 3)
            yield pa.record_batch([part.column(0), part.column(1), *(pa.array(sizes[:, i]) for i in range(3))], ["a", "b", "n", "m", "shared"])

    one = pairs.join(sets.select(F.col("set").alias("a"), F.col("shingles").alias("x")), "a")
    both = one.join(sets.select(F.col("set").alias("b"), F.col("shingles").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(counted, "a long, b long, n long, m long, shared long")


def components(links: DataFrame) -> DataFrame:
    """``node, label`` (smallest node of its component) of all ends of ``links`` ``a, b``.

    Every node points to its smallest neighbour, pointers are followed to their ends, and the links are carried over to
    these; links within one end drop out. A round leaves at most half of the nodes, and a chain of pointers takes as
    many joins as its length has binary digits.
    """
    links = written(links.select("a", "b").filter("a <> b").distinct(), "links")
    labels = None
    while True:
        ends = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = written(ends.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "pointers")
        while True:
            next_up = up.select(F.col("node").alias("label"), F.col("label").alias("far"))
            up = written(up.join(next_up, "label").select("node", F.col("label").alias("old"), F.col("far").alias("label")), "pointers")
            done = up.filter("old <> label").isEmpty()
            up = up.select("node", "label")
            if done:
                break
        if labels is None:
            labels = up
        else:
            moved = up.select(F.col("node").alias("label"), F.col("label").alias("far"))
            labels = written(labels.join(moved, "label", "left").select("node", F.coalesce("far", "label").alias("label")), "labels")
        one = links.join(up.select(F.col("node").alias("a"), F.col("label").alias("x")), "a")
        both = one.join(up.select(F.col("node").alias("b"), F.col("label").alias("y")), "b").filter("x <> y")
        links = written(both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
        if links.isEmpty():
            return labels


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: key, ``n_shingles``, ``component_id`` (smallest key reachable by links, its own included).

    Texts link when ``100 * shared >= percent * union`` of their distinct ``k``-word shingles; equal sets always do. A
    null or empty text has no shingles and links with nothing. Rows that repeat a key are documents of their own; a null
    key counts as larger than any other and is a component's name only where it has no other.
    """
    docs = docs.select(key, text)
    signed = written(signatures(docs, key, text, k, percent, common_shingles(docs, text, k)), "signatures")
    of_set = signed.filter("n > 0").groupBy("set", "n").agg(F.min("id").alias("least"))
    of_set = written(of_set, "sets")
    lists = written(index_lists(signed.filter("n > 0")), "index-lists")
    labels = _answered(docs, key, text, k, percent, signed, of_set, lists)
    named = of_set.join(labels, of_set["set"] == labels["node"], "left").select("set", "n", "least", F.coalesce("label", "set").alias("label"))
    names = named.groupBy("label").agg(F.min("least").alias("component_id"))
    sets = named.join(names, "label").select("set", "n", "component_id")
    rows = signed.select("id", "n", F.when(F.col("n") > 0, F.col("set")).alias("set"))
    out = rows.join(sets, ["set", "n"], "left")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def _answered(docs: DataFrame, key: str, text: str, k: int, percent: int, signed: DataFrame, of_set: DataFrame, lists: DataFrame) -> DataFrame:
    """``node, label``: the components of all sets that have a link."""
    spark = docs.sparkSession
    labels = spark.createDataFrame([], "node long, label long")
    tested = spark.createDataFrame([], "a long, b long")
    overlaps = spark.createDataFrame([], "set long, head long, shared long")
    degree = written(meetings(lists), "meetings")
    for heads, central in ((2, True), (8, False), (0, False)):  # central heads, others for what is open, all pairs that are then open
        best = overlaps.groupBy("set").agg(F.max(F.struct("shared", "head")).alias("best")).select("set", "best.shared", "best.head")
        state = degree.join(labels.withColumnRenamed("node", "set"), "set", "left").join(best, "set", "left")
        lists = with_state(lists, state)
        more = head_pairs(lists, percent, heads, central) if heads else open_pairs(lists, percent).withColumn("head", F.lit(None).cast("long"))
        more = written(more.join(tested, ["a", "b"], "left_anti"), "pairs")
        near = written(within_reach(more.select("a", "b"), signed, percent), "pairs-within-reach")
        wanted = written(near.select(F.explode(F.array("a", "b")).alias("set")).distinct().join(of_set, "set"), "wanted")
        found = written(compared(near, written(sets_of(docs, key, text, k, wanted), "shingle-sets")), "compared")
        links = found.filter(F.expr(f"{100 + percent} * shared >= {percent} * (n + m)")).select("a", "b")
        if not links.isEmpty():
            labels = components(labels.select(F.col("label").alias("a"), F.col("node").alias("b")).union(links))  # what is known, as stars
        if heads:
            tested = tested.union(more.select("a", "b"))
            own = found.select("a", "b", "shared").join(more, ["a", "b"]).select(F.when(F.col("head") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("set"), "head", "shared")
            overlaps = written(overlaps.union(own), "overlaps")
    return labels
