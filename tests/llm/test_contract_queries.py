"""The ten queries against plain versions of what they are to return."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidewell.llm import queries as Q
from tidewell.llm.common import read


@pytest.fixture(scope="module")
def docs(spark, sf):
    return read(spark, sf, "documents").toPandas()


def rows(spark, sf, name):
    return Q.queries()[name](spark, sf).toPandas()


def test_op1(spark, sf):
    got = rows(spark, sf, "op1_url_filters").set_index("page_id")
    pages = read(spark, sf, "pages").select("page_id", "url").toPandas()
    assert len(got) == len(pages)
    rules = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}
    for page, url in pages.itertuples(index=False):
        host = path = ""
        if url is not None and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host) :])[0]
            host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [r for r in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
        best = max(fits, key=len, default=None)
        row = got.loc[page]
        assert (row["host"], row["path"], row["rule"]) == (host, path, best)
        assert row["verdict"] == rules[best] if best else row["verdict"] == ("block" if row["score"] >= 0.5 else "allow")


def test_op2(spark, sf, docs):
    import public_tokenizers
    import sentencepiece

    got = rows(spark, sf, "op2_sentencepiece").set_index("doc_id")
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for doc, ids in zip(docs["doc_id"], library.encode(docs["text"].tolist()), strict=True):
        assert got.loc[doc, "n_tokens"] == len(ids) and got.loc[doc, "ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
    assert got["restored"].all()


def _auc(score, label):
    ranks = score.rank()
    n = label.sum()
    return (ranks[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


def test_op3(spark, sf):
    got = rows(spark, sf, "op3_quality_classifier")
    assert (got["held_out"] == [zlib.crc32(str(d).encode()) % 5 == 0 for d in got["doc_id"]]).all()
    assert got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.3)).all()
    held = got[got["held_out"]].merge(read(spark, sf, "labels").toPandas(), on="doc_id")
    assert _auc(held["score"], held["quality"]) > 0.9
    assert (held["predicted"][held["quality"] == 1]).mean() > 0.97


def test_op4(spark, sf, docs):
    got = rows(spark, sf, "op4_ngram_jaccard_join")
    sets = []
    for text in docs["text"]:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set())
    lists, parent = defaultdict(list), list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        for j, n in Counter(j for g in s for j in lists[g]).items():
            if 100 * n >= 90 * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
        for g in s:
            lists[g].append(i)
    least = defaultdict(list)
    for i, d in enumerate(docs["doc_id"]):
        least[find(i)].append(d)
    want = {d: (len(sets[i]), min(least[find(i)])) for i, d in enumerate(docs["doc_id"])}
    assert {a: (b, c) for a, b, c in got.itertuples(index=False)} == want


def test_op5(spark, sf, docs):
    got = rows(spark, sf, "op5_language_id").merge(docs[["doc_id", "lang", "text"]], on="doc_id")
    assert (got["held_out"] == [zlib.crc32(str(d).encode()) % 3 == 1 for d in got["doc_id"]]).all()
    lettered = got["text"].map(lambda t: any(c.isalpha() for c in t or ""))
    assert (got["lang_pred"][~lettered] == "und").all() and (got["lang_pred"][lettered] != "und").all()
    held = got[got["held_out"] & lettered]
    assert (held["lang"] == held["lang_pred"]).mean() > 0.97 and got["score"].between(0, 1).all()


def _base6(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen, covered, earlier, dup = Counter(grams), set(), set(), 0
    for i, g in enumerate(grams):
        if seen[g] > 1:
            covered.update((i, i + 1, i + 2))
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in earlier
            earlier.add(line)
    n, again = len(words), len(covered)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, again, n < 50 or 100 * again > 50 * n


def test_op6(spark, sf, docs):
    got = rows(spark, sf, "op6_quality_rules").set_index("doc_id")
    for doc, text in zip(docs["doc_id"], docs["text"], strict=True):
        row = got.loc[doc]
        assert tuple(row[["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]]) == _base6(text)
        assert row["kept"] == (not row["base_failed"] and row["score"] >= Q.quality_rules.THRESHOLD)
    held = got.join(read(spark, sf, "labels").toPandas().set_index("doc_id"), how="inner")
    clean = held[(held["quality"] == 1) & ~held["base_failed"]]
    assert clean["kept"].mean() > 0.98


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base7(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_op7(spark, sf, docs):
    got = rows(spark, sf, "op7_pii").set_index("doc_id")
    for doc, text in zip(docs["doc_id"], docs["text"], strict=True):
        base, row = base7(text), got.loc[doc]
        assert [row[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s[0] == k for s in base) for k in ("email", "ip", "card", "phone")]
        listed = [":".join(map(str, s)) for s in base]
        assert row["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(row["spans"].split(","))


def base8(text):
    text, out = text or "", []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 12:
            out.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 18:
            out.append((m.start(), 1, "access", m.end()))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 16:
            out.append((m.start(), 2, "hex", m.end()))
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(out)]


def test_op8(spark, sf, docs):
    got = rows(spark, sf, "op8_secret_scans").set_index("doc_id")
    for doc, text in zip(docs["doc_id"], docs["text"], strict=True):
        base, row = base8(text), got.loc[doc]
        assert [row[f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(s.startswith(k) for s in base) for k in ("assign", "access", "hex")]
        assert row["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert not base or set(base) <= set(row["spans"].split(","))


def test_op9(spark, sf, docs):
    got = rows(spark, sf, "op9_benchmark_decontamination").set_index("doc_id")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = defaultdict(set)
    for item, text in read(spark, sf, "benchmark").select("item_id", "text").collect():
        w = split(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i : i + 10])].add(item)
    sizes = {len(w) for w in windows}
    for doc, text in zip(docs["doc_id"], docs["text"], strict=True):
        w, hit, items = split(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i : i + n])):
                    items |= found
                    hit.update(range(i, i + n))
        row = got.loc[doc]
        assert (row["n_words"], row["n_hit"], row["n_items"], row["contaminated"]) == (len(w), len(hit), len(items), bool(hit))
        assert row["items_sha256"] == hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


def test_op10(spark, sf, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    got = rows(spark, sf, "op10_token_output").sort_values("doc_id")
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start = 0
    whole = docs.sort_values("doc_id")
    for row, doc, text in zip(got.itertuples(index=False), whole["doc_id"], whole["text"], strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        assert tuple(row) == (doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_sql_says_the_same(spark, sf, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    want = con.execute(Q.oracle_sql()[name])
    got = Q.queries()[name](spark, sf)
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.fetchall())
