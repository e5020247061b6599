"""The encoder against the library on odd texts, and shards of rows that share an id."""

import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidewell.llm import token_io
from tidewell.llm.queries import tokenizer

PATH = tokenizer("word_bpe_49k.json")
#: Signs, digits, white space of all kinds, letters whose lower case is longer or depends on their place, marks that compose, special tokens.
ODD = [*"aAbBzZ019.,;:/-_'\"<|>() \t\n\r\x0b\x0c\x1c\x1f\x00\x85\xa0  İıßẞÀÖØÞàöøþÿŸĀāſŉΣσςÉéHJWYK²½ªµ日한😀̱́̇̊​", "'s", "'LL", "<|startoftext|>", "<|ENDOFTEXT|>", "word", "The "]


@pytest.mark.parametrize("seed", range(3))
def test_ids_are_the_librarys(seed):
    rng, library, encoder = random.Random(seed), Tokenizer.from_file(PATH), token_io.Encoder(PATH, 1)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 14))) for _ in range(8_000)] + ["İ/f", "x İ. y", "H̱", None]
    ids, at = encoder.encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == [*library.encode(text or "", add_special_tokens=False).ids, 1], repr(text)


def test_whole_texts_and_no_end():
    library = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    ids, at = token_io.Encoder(tokenizer("byte_bpe_50k.json"), None, True).encode(pa.array(["a  b", None, "ü"]))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [library.encode(t).ids for t in ("a  b", "", "ü")]
    with pytest.raises(ValueError):
        token_io.Encoder(tokenizer("byte_bpe_50k.json"), None).encode(pa.array(["a b c"]))


def test_one_id_in_many_shards(spark, monkeypatch):
    """An id that most rows share is cut by the texts' hash; the files hold every row, in order."""
    monkeypatch.setattr(token_io, "SHARD_BYTES", 20_000)
    rows = [(7 if i % 5 else i, f"text {i % 40} " * (20 + i % 3)) for i in range(1_000)]
    manifest = token_io.write_tokens(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(4), token_io.token_folder(spark), PATH)
    assert manifest.count() > 5
    got = token_io.read_tokens(manifest).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted(i for i, _ in rows)
    library = Tokenizer.from_file(PATH)
    assert sorted((r["doc_id"], tuple(r["ids"])) for r in got) == sorted((i, (*library.encode(t, add_special_tokens=False).ids, 1)) for i, t in rows)
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(got, got[1:]))
