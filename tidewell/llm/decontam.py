"""Benchmark decontamination with a distributed positional inverted index. DataFrame operations only.

Benchmark items become windows of words. The index stores postings (term, document, place) of the
windows' two rarest terms in the corpus; a window's candidates are its offset-adjusted posting
lists' intersection. Postings of a rarest term carry the terms around it, against which
every candidate phrase is checked whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Scratch, ascii_lower, let, small

# Between words: runs of ASCII characters that are neither letters nor digits, one by one, which the matcher looks up in a bit table.
GAP = "[" + "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum()) + "]+"


def _edges(cut: Column) -> tuple[Column, Column]:
    """1 where a cut text begins, and ends, with an empty string."""
    return F.when(F.get(cut, F.lit(0)) == "", 1).otherwise(0), F.when(F.element_at(cut, -1) == "", 1).otherwise(0)


def _counted(cut: Column) -> Column:
    before, after = _edges(cut)
    return F.greatest(F.size(cut) - before - after, F.lit(0))


def _whole(cut: Column) -> Column:
    before, after = _edges(cut)
    return F.when(before + after == 0, cut).otherwise(F.slice(cut, before + 1, _counted(cut)))


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; none for null."""
    return let(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP, -1), _whole)


def n_words(text: Column) -> Column:
    return let(F.split(F.coalesce(text, F.lit("")), GAP, -1), _counted)


def terms(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


@dataclass
class Index:
    """``windows``: wid, h (its terms), and the offset and term of its rarest and second rarest; ``items``: wid, item_id;
    ``postings``: term, doc_id, th (hash of the text), pos, and for rarest terms around (terms within ``size - 1`` places)."""

    windows: DataFrame
    items: DataFrame
    postings: DataFrame
    size: int


def build(scratch: Scratch, docs: DataFrame, benchmark: DataFrame, size: int = 10) -> Index:
    """Windows of ``benchmark`` (item_id, text) and the postings of ``docs`` (doc_id, text) they need.

    An item of fewer words, but not none, is one window. Null items and ids give none. Terms are broadcast in blocks of
    at most BROADCAST_ROWS; each block is one pass over the texts.
    """
    items = benchmark.where("item_id is not null").select("item_id", terms(F.col("text")).alias("h")).where(F.size("h") > 0)
    cut = items.select("item_id", "h", F.explode(F.sequence(F.lit(0), F.greatest(F.size("h") - size, F.lit(0)))).alias("o"))
    cut = cut.select("item_id", F.slice("h", F.col("o") + 1, F.lit(size)).alias("h"))
    cut = scratch.keep(cut.withColumn("wid", F.xxhash64("h", F.size("h"))).distinct(), "cut")
    windows = cut.select("wid", "h").dropDuplicates(["wid"])
    offsets = windows.select("wid", F.posexplode("h").alias("o", "term"))
    vocabulary = scratch.keep(offsets.select("term").distinct(), "vocabulary")
    # Outer, or an inferred filter would cut every text twice.
    tokens = docs.select(F.explode_outer(words(F.col("text"))).alias("w")).select(F.xxhash64("w").alias("term"))
    counts = scratch.keep(_blocks(vocabulary, lambda v: tokens.join(v, "term").groupBy("term").agg(F.count("*").alias("n"))), "counts")
    ranked = offsets.join(counts, "term", "left").groupBy("wid").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "o", "term"))).alias("r"))
    windows = scratch.keep(
        windows.join(ranked.where("r[0].n > 0"), "wid").select("wid", "h", F.expr("r[0].o").alias("o1"), F.expr("r[0].term").alias("t1"), F.expr("get(r, 1).o").alias("o2"), F.expr("get(r, 1).term").alias("t2")),
        "windows",
    )
    anchors = windows.select(F.col("t1").alias("term"), F.lit(1).alias("f")).unionByName(windows.where("t2 is not null").select(F.col("t2").alias("term"), F.lit(0).alias("f")))
    anchors = scratch.keep(anchors.groupBy("term").agg(F.max("f").alias("f")), "anchors")
    hashed = docs.select("doc_id", F.xxhash64("text").alias("th"), terms(F.col("text")).alias("h"))
    places = hashed.select("doc_id", "th", "h", F.posexplode_outer("h").alias("pos", "term"))
    near = F.expr(f"if(f = 1, transform(sequence(1 - {size}, {size} - 1), k -> get(h, pos + k)), null)")
    postings = scratch.keep(_blocks(anchors, lambda a: places.join(a, "term").select("term", "doc_id", "th", "pos", near.alias("around"))), "postings")
    scratch.drop("vocabulary", "counts", "anchors")
    return Index(windows, cut.select("wid", "item_id").distinct(), postings, size)


def _blocks(side: DataFrame, use) -> DataFrame:
    """``use`` of the whole side, broadcast, or of its blocks by hash if it is too large for that."""
    n = 1 + (side.count() - 1) // BROADCAST_ROWS
    if n <= 1:
        return use(F.broadcast(side))
    out = None
    for i in range(2 * n):
        part = use(F.broadcast(side.where(F.pmod(F.xxhash64("term", F.lit(5)), F.lit(2 * n)) == i)))
        out = part if out is None else out.unionByName(part)
    return out


def phrases(index: Index) -> DataFrame:
    """Every occurrence of a window in a document: doc_id, th, start, n (words) and wid."""
    w, p = small(index.windows), index.postings
    first = p.where("around is not null").join(w, F.col("term") == F.col("t1")).where("pos >= o1").select("wid", "doc_id", "th", (F.col("pos") - F.col("o1")).alias("start"), "around", "o1", "h", "t2")
    second = p.join(w.where("t2 is not null"), F.col("term") == F.col("t2")).where("pos >= o2").select("wid", "doc_id", "th", (F.col("pos") - F.col("o2")).alias("start"))
    both = first.where("t2 is not null").alias("a").join(second.alias("b"), F.expr("a.wid = b.wid and a.doc_id <=> b.doc_id and a.th = b.th and a.start = b.start")).select("a.*")
    found = both.unionByName(first.where("t2 is null"))
    whole = F.expr(f"slice(around, {index.size} - o1, size(h)) = h")
    return found.where(whole).select("doc_id", "th", "start", F.size("h").alias("n"), "wid")


def near(index: Index, slop: int = 5) -> DataFrame:
    """Proximity matches: documents where a window's two rarest terms stand in order within ``slop`` places of their distance there.

    doc_id, th, wid, and the least difference of distances. Places are joined by blocks of ``2 * slop + 2 * size`` words.
    """
    span = 2 * slop + 2 * index.size
    w = small(index.windows.where("t2 is not null"))
    first = index.postings.join(w, F.col("term") == F.col("t1")).select("wid", "doc_id", "th", F.expr("pos - o1").alias("s"))
    second = index.postings.join(w, F.col("term") == F.col("t2")).select("wid", "doc_id", "th", F.expr("pos - o2").alias("s"))
    first = first.withColumn("block", F.expr(f"floor(s / {span})"))
    second = second.withColumn("block", F.explode(F.array_distinct(F.array(F.expr(f"floor((s - {slop}) / {span})"), F.expr(f"floor((s + {slop}) / {span})")))))
    both = first.alias("a").join(second.alias("b"), F.expr(f"a.wid = b.wid and a.doc_id <=> b.doc_id and a.th = b.th and a.block = b.block and abs(a.s - b.s) <= {slop}"))
    return both.groupBy("a.doc_id", "a.th", "a.wid").agg(F.min(F.expr("abs(a.s - b.s)")).alias("off"))


def proximity(spark: SparkSession, scratch: Scratch, index: Index, slop: int = 5) -> DataFrame:
    """doc_id, th and n_near, the windows that a document holds loosely: rarest terms in order, within ``slop`` places of their distance."""
    return scratch.keep(near(index, slop).groupBy("doc_id", "th").agg(F.count_distinct("wid").alias("n_near")), "near")


def contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, size: int = 10, loose: bool = False) -> DataFrame:
    """The contaminated rows only: doc_id, th (hash of the text), n_hit and the sorted items that occur; ``loose`` adds rows with proximity matches, and n_near."""
    scratch = Scratch(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    index = build(scratch, docs, benchmark, size)
    hits = scratch.keep(phrases(index), "hits")
    spans = hits.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set(F.struct("start", F.col("n").alias("n")))).alias("s"))
    cover = "aggregate(s, named_struct('end', 0, 'hit', 0), (a, x) -> named_struct('end', greatest(a.end, x.start + x.n), 'hit', a.hit + greatest(0, x.start + x.n - greatest(a.end, x.start))), a -> a.hit)"
    spans = spans.select("doc_id", "th", F.expr(cover).cast("long").alias("n_hit"))
    named = hits.select("doc_id", "th", "wid").distinct().join(small(index.items), "wid").select("doc_id", "th", F.col("item_id").cast("string").alias("item")).distinct()
    named = named.groupBy("doc_id", "th").agg(F.array_sort(F.collect_list("item")).alias("items"))
    dirty = spans.alias("a").join(named.alias("b"), F.expr("a.doc_id <=> b.doc_id and a.th = b.th")).select("a.doc_id", "a.th", "n_hit", "items")
    if loose:
        close = proximity(spark, scratch, index)
        dirty = dirty.alias("a").join(close.alias("b"), F.expr("a.doc_id <=> b.doc_id and a.th = b.th"), "full").select(F.coalesce("a.doc_id", "b.doc_id").alias("doc_id"), F.coalesce("a.th", "b.th").alias("th"), "n_hit", "items", "n_near")
    dirty = scratch.keep(dirty, "dirty")
    scratch.drop("cut", "windows", "postings", "hits", *["near"] * loose)
    return dirty


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with n_words, n_hit (words in any occurrence), n_items, items_sha256, contaminated and n_near (windows with a proximity match).

    Null and empty texts have no words. A row is known by doc_id and text: equal rows get equal results. Items that
    can't occur, an empty benchmark or an empty table leave all documents clean.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dirty = small(contaminated(spark, docs, benchmark, size, True))
    base = docs.select("doc_id", F.xxhash64("text").alias("th"), n_words(F.col("text")).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    return base.alias("d").join(dirty.alias("h"), F.expr("d.doc_id <=> h.doc_id and d.th = h.th"), "left").select(
        "d.doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ",").cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )
