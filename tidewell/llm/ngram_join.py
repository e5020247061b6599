"""N-gram Jaccard join by vertical partitioning.

All shingles stand in one global order: those not known as frequent first, by hash, then the frequent ones by
count. Pivots at equal shares of the corpus cut the order into fragments, and every set into one segment a fragment.
Two sets can only be linked if they share one of the first shingles of their order, which lie in the first fragments; there
candidates are found, under bounds on sizes, places, segment lengths and parity sketches. A candidate pair's overlap is then counted
in each fragment separately, and the counts are summed per pair. Equal sets collapse into one class first. In two rounds each class
tries its likeliest leader of the posting lists it is in (rows linear in the lists), and
what those links join isn't compared again; pairs still apart are then all checked, in
blocks by size and salt, so that no link between components is missed.

The frequent shingles are a bounded list, however large the corpus; what isn't listed only makes longer posting lists. The result doesn't
depend on the order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, arrow_map, batch_words, forget, mix, pa_schema, small, small_batches, trim
from .components import components

#: Shingles listed as frequent at most; how many are counted at once, and how often one of those has to stand there to count.
LISTED, COUNTED, LEAST = 1 << 18, 1 << 21, 3
#: Fragments of the global order.
FRAGMENTS = 8
#: Longer posting lists are salted into blocks of about this many members.
BLOCK = 256
#: Bits (as a power of two) of a set's parity sketch, by least size of the set.
PARITY = ((8000, 14), (2000, 12), (64, 10), (0, 8))
#: Posting lists of at most so many members pair before they fetch sketches.
SHORT = 64
#: Rounds over the pairs that are left, and how few of them are all verified at once.
REST_ROUNDS, REST_PAIRS = 3, 2_000
#: Bijections that pick the two leaders of a posting list, for each round.
MASKS = (0, 0x5555555555555555)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; the whole sequence if it has fewer words."""
    if not len(words):
        return words
    n = min(k, len(words))
    out = np.full(len(words) - n + 1, n * 0xA24BAED4963EE407 % (1 << 64), np.uint64)
    for j in range(n):
        out = out * np.uint64(0x9FB21C651E98DF25) + words[j : j + len(out)]
    return np.unique(mix(out))


def _prefix(n: int, num: int, den: int) -> int:
    return n - (num * n + den - 1) // den + 1


class Order:
    """The global order, by (count, hash) with 0 for what isn't listed, and its pivots."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, total: int):
        at = np.argsort(hashes)
        self.hashes, self.counts = hashes[at], counts[at].astype(np.int64)
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[(self.hashes >> np.uint64(42)).astype(np.int64)] = True
        # Shares of the corpus: the unlisted shingles' hashes are even, the listed ones count as they are.
        rest = max(total - int(self.counts.sum()), 1)
        goals = [total * f / FRAGMENTS for f in range(1, FRAGMENTS)]
        self.pivots = np.array([min(int(g / rest * 2.0**64), (1 << 64) - 1) for g in goals if g < rest], np.uint64)
        place = np.lexsort((self.hashes, self.counts))
        self.fragment = np.zeros(len(place), np.int64)
        self.fragment[place] = np.searchsorted(np.array(goals), rest + np.cumsum(self.counts[place]) - self.counts[place], "right")

    def find(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the sorted hashes are listed, and where."""
        some = np.flatnonzero(self.maybe[(s >> np.uint64(42)).astype(np.int64)])
        at = np.searchsorted(self.hashes, s[some])
        hit = np.zeros(0, bool) if not len(self.hashes) else self.hashes[np.minimum(at, len(self.hashes) - 1)] == s[some]
        return some[hit], at[hit]

    def first(self, s: np.ndarray, n: int) -> np.ndarray:
        """The first ``n`` of the sorted hashes in the global order."""
        here, at = self.find(s)
        rare = np.delete(s, here)
        return rare[:n] if len(rare) >= n else np.concatenate([rare, s[here][np.argsort(self.counts[at], kind="stable")][: n - len(rare)]])

    def fragments(self, s: np.ndarray) -> np.ndarray:
        """The fragment of each of the sorted hashes."""
        out = np.searchsorted(self.pivots, s, "right")
        here, at = self.find(s)
        out[here] = self.fragment[at]
        return out


def global_order(docs: DataFrame, k: int) -> Order:
    """The order of all documents' shingles: those that often repeat in what a task counts at once are summed, the most frequent ones listed.

    At most LISTED rows reach the driver.
    """
    kind = pa_schema(docs.sparkSession, "b long, c long")
    small_batches(docs.sparkSession)

    def counted(batches):
        held, size, total = [], 0, 0
        forget()

        def block():
            found, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= LEAST
            return pa.RecordBatch.from_pydict({"b": found[often].view(np.int64), "c": n[often].astype(np.int64)}, schema=kind)

        for _, words, _, _ in (row for batch in batches if batch.num_rows for row in batch_words(batch, "text")):
            held.append(shingle_hashes(words, k))
            size += len(held[-1])
            total += len(held[-1])
            if size >= COUNTED:
                yield block()
                held, size = [], 0
        if held:
            yield block()
        yield pa.RecordBatch.from_pydict({"b": [None], "c": [total]}, schema=kind)
        held.clear()
        trim()

    sums = docs.select("text").mapInArrow(counted, "b long, c long").groupBy("b").agg(F.sum("c").alias("c"))
    rows = sums.orderBy(F.col("b").isNotNull(), F.col("c").desc(), "b").limit(LISTED + 1).toArrow()
    listed = rows.filter(pc.is_valid(rows.column("b")))
    total = pc.sum(rows.filter(pc.is_null(rows.column("b"))).column("c")).as_py() or 0
    return Order(listed.column("b").to_numpy().view(np.uint64), listed.column("c").to_numpy(), total)


def _key(s: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of a set; the first is its node in the graph of links."""
    return np.array([mix(s).sum(), np.bitwise_xor.reduce(mix(s ^ np.uint64(0xC2B2AE3D27D4EB4F)))], np.uint64).view(np.int64)


def prefixes(docs: DataFrame, order, k: int, num: int, den: int) -> DataFrame:
    """Per row: doc_id, set size n, two hashes of the set, its first shingles in the global order, its segments' lengths and a parity sketch."""

    def run(batch):
        known, size = order.value, batch.num_rows
        out = {"doc_id": batch.column("doc_id"), "n": np.zeros(size, np.int64), "k1": np.zeros(size, np.int64), "k2": np.zeros(size, np.int64), "pre": [[]] * size, "lens": [[]] * size, "sig": [[]] * size}
        for i, words, _, _ in batch_words(batch, "text"):
            s = shingle_hashes(words, k)
            if not len(s):
                continue
            out["n"][i] = len(s)
            out["k1"][i], out["k2"][i] = _key(s)
            out["pre"][i] = known.first(s, _prefix(len(s), num, den)).view(np.int64)
            out["lens"][i] = np.bincount(known.fragments(s), minlength=FRAGMENTS).astype(np.int32)
            bits = next(b for least, b in PARITY if len(s) >= least)
            odd = np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits) & 1
            out["sig"][i] = np.packbits(odd.astype(np.uint8)).view(np.int64)
        return out

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, n long, k1 long, k2 long, pre array<long>, lens array<int>, sig array<long>")


def segments(docs: DataFrame, order, k: int) -> DataFrame:
    """Sets cut at the pivots: rep, fragment number, and the shingles in it."""

    def run(batch):
        known, out = order.value, {"rep": [], "f": [], "part": []}
        for _, words, _, _ in batch_words(batch, "text"):
            s = shingle_hashes(words, k)
            if not len(s):
                continue
            place = known.fragments(s)
            for f in np.unique(place).tolist():
                out["rep"].append(_key(s)[0])
                out["f"].append(f)
                out["part"].append(s[place == f].view(np.int64))
        return out

    return arrow_map(docs, run, "rep long, f int, part array<long>")


def _verified(scratch: Scratch, pairs: DataFrame, classes: DataFrame, docs: DataFrame, order, k: int, num: int, den: int, name: str) -> DataFrame:
    """Links among candidate pairs (x, y, nx, ny): those whose overlaps in the fragments sum to the threshold. Only their documents are cut."""
    ends = pairs.select("*", F.explode(F.array("x", "y")).alias("rep"))
    ends = scratch.keep(ends.join(classes.select("rep", "first"), "rep"), f"ends-{name}")
    parts = segments(docs.join(small(ends.select(F.col("first").alias("doc_id")).distinct()), "doc_id", "left_semi"), order, k)
    # A pair's two segments meet in each fragment; as a set, because a text may be there again under the same id.
    both = parts.join(small(ends), "rep").groupBy("x", "y", "nx", "ny", "f").agg(F.collect_set(F.struct("rep", "part")).alias("s"))
    counted = both.where("size(s) = 2").select("x", "y", "nx", "ny", F.expr("size(array_intersect(s[0].part, s[1].part)) common"))
    linked = counted.groupBy("x", "y", "nx", "ny").agg(F.sum("common").alias("common")).where(f"{num + den} * common >= {num} * (nx + ny)")
    links = scratch.keep(linked.select("x", "y"), f"links-{name}")
    scratch.drop(f"ends-{name}")
    return links


def _best(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """Of each class's candidate pairs (rep, lead, n, m) the one whose parity sketches differ least for the sizes, if they may be linked."""
    side = lambda c: classes.select(F.col("rep").alias(c), F.col("lens").alias(f"l_{c}"), F.col("sig").alias(f"s_{c}"))
    seen = pairs.join(side("rep"), "rep").join(side("lead"), "lead").where(_segments("l_rep", "l_lead", "(n + m)", num, den))
    seen = seen.withColumn("bits", F.expr(_bits("s_rep", "s_lead"))).where(f"{num + den} * bits <= {den - num} * (n + m)")
    best = seen.groupBy("rep").agg(F.min(F.struct((F.col("bits") / (F.col("n") + F.col("m"))).alias("d"), "lead", "n", "m")).alias("b")).select("rep", "b.lead", "b.n", "b.m")
    first = F.col("rep") < F.col("lead")
    return best.select(F.least("rep", "lead").alias("x"), F.greatest("rep", "lead").alias("y"), F.when(first, F.col("n")).otherwise(F.col("m")).alias("nx"), F.when(first, F.col("m")).otherwise(F.col("n")).alias("ny")).distinct()


def _bits(a: str, b: str) -> str:
    """Differing bits of two parity sketches, a lower bound of the sets' difference; 0 for sketches of unlike sizes."""
    return f"if(size({a}) = size({b}), aggregate(zip_with({a}, {b}, (p, q) -> bit_count(p ^ q)), 0, (s, z) -> s + z), 0)"


def _segments(a: str, b: str, n: str, num: int, den: int) -> str:
    """Whether the shorter one of each two segments, summed, allows the overlap that a link needs."""
    return f"{num + den} * aggregate(zip_with({a}, {b}, (p, q) -> least(p, q)), 0, (s, z) -> s + z) >= {num} * {n}"


def _near(a: str, b: str, num: int, den: int) -> str:
    """Bounds that every linked pair meets at its first shared prefix shingle: sizes, and what can still be common from there on."""
    n = f"({a}.n + {b}.n)"
    return f"{den} * least({a}.n, {b}.n) >= {num} * greatest({a}.n, {b}.n) and {num + den} * least({a}.n - {a}.pos, {b}.n - {b}.pos) >= {num} * {n}"


def jaccard_components(spark: SparkSession, docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """Group documents (doc_id, text) whose k-word shingle sets have Jaccard similarity ``num/den`` or more.

    Returns doc_id, n_shingles, component_id: the least doc_id reachable by links, itself included.
    Words are runs without ASCII white space, A-Z lower-cased; with fewer than k words the whole
    sequence is one shingle. Null and empty texts have no shingles and link with nothing. A row is judged by its text:
    rows that repeat a doc_id with other texts may lie in components of their own. A row without doc_id keeps its size and has no component. An
    empty table gives an empty result; other columns are ignored.
    """
    scratch = Scratch(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = spark.sparkContext.broadcast(global_order(docs, k))
    base = scratch.keep(prefixes(docs, order, k, num, den), "sets")
    some = base.where("n > 0 and doc_id is not null")
    picked = some.groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("first"), F.min_by(F.struct("pre", "lens", "sig"), "doc_id").alias("best"))
    classes = scratch.keep(picked.select(F.col("k1").alias("rep"), "k2", "n", "first", "best.*"), "classes")
    entry = classes.select("rep", "n", F.posexplode("pre").alias("pos", "tok"))
    # Lists are counted before the rows meet them, so that a join may split a long one.
    lists = scratch.keep(entry.groupBy("tok").agg(F.count("*").alias("size")).where("size > 1").select("tok"), "lists")
    listed = scratch.keep(entry.join(lists, "tok"), "listed")
    verified = lambda pairs, name: _verified(scratch, pairs, classes, docs, order, k, num, den, name)
    links, label = None, None
    for turn, mask in enumerate(MASKS):
        now = listed.withColumn("comp", F.col("rep")) if label is None else scratch.keep(listed.join(label, "rep"), f"now{turn}")
        picks = [f(F.col("rep").bitwiseXOR(F.lit(mask))).bitwiseXOR(F.lit(mask)) for f in (F.min, F.max)]
        lead = now.groupBy("tok").agg(F.array(*picks).alias("lead"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("tok", F.explode(F.array_distinct("lead")).alias("rep"))
        lead = scratch.keep(lead.join(now, ["tok", "rep"]), f"lead{turn}")
        pairs = lead.alias("a").join(now.alias("b"), F.expr(f"a.tok = b.tok and a.comp <> b.comp and {_near('a', 'b', num, den)}")).select("b.rep", F.col("a.rep").alias("lead"), "b.n", F.col("a.n").alias("m")).distinct()
        found = verified(_best(pairs, classes, num, den), str(turn))
        links = found if links is None else links.unionByName(found)
        graph, label = _label(scratch, links, listed, turn)
    rest = _left(scratch, listed, label, classes, num, den)
    for turn in range(REST_ROUNDS):
        comp = lambda c: label.select(F.col("rep").alias(c), F.col("comp").alias(f"c{c}"))  # noqa: E731, B023
        rest = scratch.keep(rest.join(comp("x"), "x").join(comp("y"), "y").where("cx <> cy").select("x", "y", "nx", "ny", "d", F.least("cx", "cy").alias("a"), F.greatest("cx", "cy").alias("b")), f"rest{turn}")
        few = rest.limit(REST_PAIRS + 1).count()
        if not few:
            break
        last = turn == REST_ROUNDS - 1 or few <= REST_PAIRS
        # The likeliest pair of each two components, and all that are left in the end.
        tried = rest if last else rest.groupBy("a", "b").agg(F.min(F.struct("d", "x", "y", "nx", "ny")).alias("p")).select("p.*")
        tried = tried.select("x", "y", "nx", "ny")
        links = links.unionByName(verified(tried, f"rest{turn}"))
        graph, label = _label(scratch, links, listed, len(MASKS) + turn)
        if last:
            break
        rest = rest.join(tried.select("x", "y"), ["x", "y"], "left_anti").drop("a", "b")
    # Only classes with links need a component; the others are their own.
    linked = scratch.keep(graph.withColumnRenamed("node", "rep").join(classes.select("rep", "first"), "rep"), "linked")
    least = scratch.keep(linked.groupBy("component").agg(F.min("first").alias("component_id")), "least")
    linked = scratch.keep(linked.join(least, "component").select("rep", "component_id"), "members")
    scratch.drop(*[x for x in scratch.paths if x not in ("sets", "classes", "members")])
    order.destroy()
    member = classes.join(linked, "rep", "left").select(F.col("rep").alias("k1"), "k2", "n", F.coalesce("component_id", "first").alias("component_id"))
    own = base.where("n > 0").select("doc_id", "n", "k1", "k2").join(member, ["k1", "k2", "n"], "left")
    own = own.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
    return own.unionByName(base.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def _left(scratch: Scratch, listed: DataFrame, label: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """All pairs of classes of two components that share a posting list and meet every bound: x, y, nx, ny and the sketches' difference d.

    Short lists pair first, and the few pairs of like sizes then fetch their sketches. Members of long lists carry the sketches, meet only
    members of their own size class and the next, and are salted.
    """
    now = scratch.keep(listed.join(label, "rep"), "now-left")
    open_ = now.groupBy("tok").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m")).where("lo < hi").select("tok", "m")
    now = scratch.keep(now.join(scratch.keep(open_, "open-lists"), "tok"), "open")
    pair = [F.expr(e) for e in ("a.rep x", "b.rep y", "a.n nx", "b.n ny")]
    side = lambda c: classes.select(F.col("rep").alias(c), F.col("lens").alias(f"l{c}"), F.col("sig").alias(f"s{c}"))
    short = now.where(f"m <= {SHORT}")
    short = short.alias("a").join(short.alias("b"), F.expr(f"a.tok = b.tok and a.rep < b.rep and a.comp <> b.comp and {_near('a', 'b', num, den)}")).select(*pair).distinct()
    short = short.join(side("x"), "x").join(side("y"), "y").where(_segments("lx", "ly", "(nx + ny)", num, den))
    short = short.where(f"{num + den} * {_bits('sx', 'sy')} <= {den - num} * (nx + ny)").select("x", "y", "nx", "ny", F.expr(f"{_bits('sx', 'sy')} / (nx + ny) d"))
    # A size class is a little wider than the threshold's factor, so that linked sets are of one class or of neighbours.
    long = now.where(f"m > {SHORT}").withColumn("size", F.expr(f"cast(floor(ln(n) / (1.000001 * ln({den} / {num}))) as int)"))
    blocks = long.groupBy("tok", "size").agg(F.count("*").alias("in_size")).select("tok", "size", F.expr(f"cast(1 + in_size div {BLOCK} as int) salts"))
    blocks = small(scratch.keep(blocks, "blocks"))
    long = long.join(classes.select("rep", "lens", "sig"), "rep")
    left = long.join(blocks, ["tok", "size"]).withColumn("salt", F.expr("cast(pmod(xxhash64(rep), salts) as int)"))
    right = long.withColumn("size", F.explode(F.expr("array(size - 1, size)"))).join(blocks, ["tok", "size"]).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    near = f"{_near('a', 'b', num, den)} and {_segments('a.lens', 'b.lens', '(a.n + b.n)', num, den)} and {num + den} * {_bits('a.sig', 'b.sig')} <= {den - num} * (a.n + b.n)"
    met = left.alias("a").join(right.alias("b"), F.expr(f"a.tok = b.tok and a.size = b.size and a.salt = b.salt and a.comp <> b.comp and a.rep <> b.rep and {near}"))
    met = met.select(F.expr("least(a.rep, b.rep) x"), F.expr("greatest(a.rep, b.rep) y"), F.expr("if(a.rep < b.rep, a.n, b.n) nx"), F.expr("if(a.rep < b.rep, b.n, a.n) ny"), F.expr(f"{_bits('a.sig', 'b.sig')} / (a.n + b.n) d"))
    return short.unionByName(met).distinct()


def _label(scratch: Scratch, links: DataFrame, listed: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """Components of the links so far (node, component), and the component of every class in a list: rep, comp."""
    graph = components(scratch, links.select(F.col("x").alias("u"), F.col("y").alias("v")), f"graph{turn}-")
    label = listed.select("rep").distinct().join(graph.withColumnRenamed("node", "rep"), "rep", "left").select("rep", F.coalesce("component", "rep").alias("comp"))
    return graph, scratch.keep(label, f"label{turn}")
