"""Secret scans: patterns propose candidates, and corpus-wide ownership tells widely copied
examples from credentials of one owner. DataFrame operations only.

Places of matches come from the text cut at them: lengths of the cuts and of the matches
are summed in turn. Candidates alone, not texts, are grouped by hash, owner and repository.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, let, private, small

# A private key: header, lines such as Proc-Type, and the body, which is the value: up to the footer of the same label if only an encoded key's characters,
# not mere words, stand there or a long piece begins it; else the run of long pieces. A quoted header or footer alone is none. Possessive loops: linear time.
_B, _BETWEEN = "[A-Za-z0-9+/]", r"""[\s\\"',>#*|]"""
_SKIP = rf"(?:\\[nrt]|{_BETWEEN})"
_LINES = rf"(?:(?:Proc-Type:\x20*[0-9],[A-Z]++|DEK-Info:\x20*[A-Z0-9-]++,[0-9A-Fa-f]++|[A-Z][A-Za-z-]{{1,30}}:\x20[^\r\n\\]*+){_SKIP}++)*+"
_FOOTER = r"-----END \1PRIVATE KEY-----"
_BODY = rf"""(?=[A-Za-z0-9+/=\s\\"',>#*|]++{_FOOTER})(?=[^-]*?(?:{_B}{{16}}|[0-9]))[^-]++|(?={_B}{{20}})(?:[^-]++|-(?!----))++(?={_FOOTER})|{_B}{{20,}}+(?:{_SKIP}++(?:\+{_SKIP}++)?+{_B}{{20,}}+)*+(?:{_SKIP}++{_B}{{1,19}}+(?=[=\r\n"'`<\\]|[\x20\t]*+$))?+={{0,2}}"""
_PRIVATE_KEY = rf"-----BEGIN ([A-Z ]{{0,20}})PRIVATE KEY-----{_SKIP}*+{_LINES}({_BODY})(?:{_FOOTER})?"

# Kinds in order: name, pattern, group of the value, least length of the value, cheap test of the text. Fixed values; the first three are the base kinds.
KINDS = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12, r"""[pPsStTaA](?i:assword|asswd|ecret|oken|pi_?key)["']?\x20*[:=]"""),
    ("access", r"AKIA[A-Z0-9]+", 0, 18, None),
    ("hex", r"(?<![0-9a-f])[0-9a-f]{16,}+", 0, 16, r"[0-9a-f]{16}"),
    ("github", r"(?<![A-Za-z0-9_])gh[pousr]_[A-Za-z0-9]{20,}+", 0, 24, "gh[pousr]_"),
    ("slack", r"(?<![A-Za-z0-9])xox[abprs]-[A-Za-z0-9-]{10,}+", 0, 15, "xox[abprs]-"),
    ("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", 0, 30, "eyJ"),
    ("private_key", _PRIVATE_KEY, 2, 20, "PRIVATE KEY-----"),
)
BASE = 3
#: From so many owners on a candidate counts as widely copied, however many repositories of an owner hold it.
COPIED_OWNERS = 3
#: Distinct characters a live-looking value has at least.
LIVE_CHARS = 6


def _matches(text: Column, kind: int) -> Column:
    """Spans of one kind: kind number, start, end (code points) and value. Matches too short are dropped, not retried."""
    _, pattern, group, least, test = KINDS[kind]
    has = text.contains("AKIA") if test is None else text.rlike(test)

    def spans(cut: Column, found: Column, values: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), F.array().cast("array<int>").alias("starts"))
        step = lambda s, m: let(s["at"] + F.length(F.get(cut, s["i"])), lambda a: F.struct((a + F.length(m)).alias("at"), (s["i"] + 1).alias("i"), F.concat(s["starts"], F.array(a)).alias("starts")))
        starts = F.aggregate(found, zero, step, lambda s: s["starts"])
        return let(starts, lambda st: F.filter(F.transform(found, lambda m, i: F.struct(F.get(st, i).alias("start"), F.lit(kind).alias("kind"), (F.get(st, i) + F.length(m)).alias("end"), F.get(values, i).alias("value"))), lambda x: F.length(x["value"]) >= least))

    rx = F.lit(pattern)
    found = let(F.split(text, pattern, -1), lambda cut: let(F.regexp_extract_all(text, rx, F.lit(0)), lambda m: let(F.regexp_extract_all(text, rx, F.lit(group)), lambda v: spans(cut, m, v))))
    return F.when(has, found).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>"))


def candidates(docs: DataFrame, owner: str = "source", repo: str = "doc_id") -> DataFrame:
    """Every row's doc_id, hash of the text (th), owner, repo and spans by start, then kind; null texts have none. One pass, no shuffle."""
    text = F.coalesce("text", F.lit(""))
    spans = F.array_sort(F.concat(*[_matches(F.col("text"), k) for k in range(len(KINDS))]))
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), F.col(owner).cast("string").alias("owner"), F.col(repo).cast("string").alias("repo"), text.alias("text"))
    return rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "th", "owner", "repo", spans.alias("spans"))


def ownership(found: DataFrame) -> DataFrame:
    """For each candidate's hash: distinct owners and repositories (of an owner) that hold it.

    Each step sums map-side, so a candidate in a third of all rows costs a row per task.
    """
    each = found.select("hash", F.coalesce("owner", F.lit("")).alias("owner"), F.coalesce("repo", F.lit("")).alias("repo"))
    by_repo = each.groupBy("hash", "owner", "repo").agg(F.count("*").alias("uses"))
    by_owner = by_repo.groupBy("hash", "owner").agg(F.count("*").alias("repos"), F.sum("uses").alias("uses"))
    return by_owner.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"), F.sum("uses").alias("n_uses"))


def scan(spark: SparkSession, docs: DataFrame, owner: str = "source", repo: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Rows with their spans (``candidates``), and judged candidates: row, doc_id, th, start, end, kind, value, n_owners, n_repos, live.

    A candidate is live if few owners hold its value, in however many of their repositories, and the value has enough distinct characters. Private keys are
    the same value however their lines are broken.
    """
    scratch = Scratch(spark)
    rows = scratch.keep(candidates(docs, owner, repo), "secrets")
    found = rows.where(F.size("spans") > 0).select("row", "doc_id", "th", "owner", "repo", F.explode("spans").alias("s")).select("row", "doc_id", "th", "owner", "repo", "s.*")
    same = F.when(F.col("kind") == len(KINDS) - 1, F.regexp_replace("value", r"\\[nrt]|[^A-Za-z0-9+/]", "")).otherwise(F.col("value"))
    found = found.withColumn("hash", F.sha2(same.cast("binary"), 256))
    held = scratch.keep(ownership(found), "ownership")
    judged = found.join(small(held), "hash")
    few = (F.col("n_owners") < COPIED_OWNERS) & (F.size(F.array_distinct(F.split("value", ""))) >= LIVE_CHARS)
    return rows, judged.withColumn("live", few).drop("hash")


def digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, the list of all spans, and how many are live or widely copied."""
    rows, judged = scan(spark, docs)
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    listed = lambda x: F.array_join(F.transform(x, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind][0]}")
    counts = [number(k) for k in range(BASE)]
    live = judged.groupBy("row").agg(F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_copied"))
    whole = rows.select("row", "doc_id", *counts, F.sha2(listed(F.filter("spans", lambda s: s["kind"] < BASE)).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
    return whole.join(live, "row", "left").select("doc_id", *[f"n_{KINDS[k][0]}" for k in range(BASE)], "base_sha256", "spans", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_live", "n_copied")])


def _cut(text: Column, spans: Column) -> Column:
    """The text with ``[SECRET]`` for each span (start, end); what overlaps is one."""
    mark = F.lit("[SECRET]")
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    step = lambda s, x: F.when(x["start"] < s["at"], F.struct(F.greatest(s["at"], x["end"]).alias("at"), s["out"].alias("out"))).otherwise(F.struct(x["end"].alias("at"), F.concat(s["out"], F.substring(text, s["at"] + 1, x["start"] - s["at"]), mark).alias("out")))
    return F.aggregate(spans, zero, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))


def redact(spark: SparkSession, docs: DataFrame, owner: str = "source", repo: str = "doc_id") -> DataFrame:
    """All columns of ``docs`` with every live value of a row replaced by ``[SECRET]``, and n_chars set anew where the text changed. Rows are known by
    doc_id, null or not, and text.

    Spans go as they were found, a private key whole; after that a live value goes wherever else it stands as a word of its own in the row. A longer word that
    holds it stays. Only documents with live values meet a join side; that side is broadcast if it is small.
    """
    _, judged = scan(spark, docs, owner, repo)
    id_, th, spans, words = (private(n) for n in ("id", "th", "spans", "words"))
    whole = F.col("kind") == len(KINDS) - 1
    span = F.struct(F.when(whole, F.col("start")).otherwise(F.col("end") - F.length("value")).alias("start"), F.col("end").alias("end"))
    values = judged.where("live").groupBy(F.col("doc_id").alias(id_), F.col("th").alias(th)).agg(F.array_sort(F.collect_set(span)).alias(spans), F.sort_array(F.collect_set(F.when(~whole, F.struct(F.length("value").alias("n"), "value"))), False).alias(words))
    values = small(Scratch(spark).keep(values, "live"))
    word = "[A-Za-z0-9+/_=-]"
    clean = F.aggregate(words, _cut(F.col("text"), F.col(spans)), lambda t, v: F.regexp_replace(t, F.concat(F.lit(f"(?<!{word})\\Q"), v["value"], F.lit(f"\\E(?!{word})")), F.lit("[SECRET]")))
    found = F.col(spans).isNotNull()
    joined = docs.join(values, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(th)), "left").withColumn(words, F.when(found, clean).otherwise(F.col("text")))
    new = {"text": F.col(words), "n_chars": F.when(found, F.length(words).cast("long")).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None}
    return joined.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])
