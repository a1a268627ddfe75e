"""Very long texts and empty tables of operators whose other tests have neither."""

import hashlib
import zlib

from pyspark.sql import functions as F

from cytoloom.llm import chat, exact_dedup, sharding, tokens
from cytoloom.llm.common import small

LONG = "abc é \n" * 300_000


def test_shards_take_very_long_texts(spark):
    df = spark.createDataFrame([(1, LONG), (2, "x"), (3, LONG)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in sharding.shard(df, 2).collect()}
    data = LONG.encode()
    assert got[1]["size"] == len(data) + 16 and got[1]["text_crc32"] == got[3]["text_crc32"] == zlib.crc32(data)
    assert sorted((r["shard"], r["slot"]) for r in got.values()) == [(0, 0), (0, 1), (1, 0)]


def test_copies_of_very_long_texts_meet(spark):
    df = spark.createDataFrame([(1, LONG), (2, LONG + " "), (3, LONG + "d")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in exact_dedup.exact_groups(df).collect()}
    assert [(got[i]["keep_id"], got[i]["group_size"], got[i]["kept"]) for i in (1, 2, 3)] == [(2, 2, False), (2, 2, True), (3, 1, True)]
    assert got[1]["text_sha256"] == hashlib.sha256(("abcé" * 300_000).encode()).hexdigest()


def test_tokens_of_a_long_text_without_spaces(spark):
    pieces = [("a", -1.0), ("aa", -1.5), ("▁", -1.0)]
    got = tokens.count_tokens(spark.createDataFrame([("a" * 200_001,)], "text string"), pieces).first()
    assert got["n_tokens"] == 1 + 100_001 and abs(got["score"] + 1 + 1.5 * 100_000 + 1) < 1e-3


def test_chat_examples_of_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.examples(none).count() == 0


def test_a_long_word_takes_a_window():
    import random
    import tracemalloc

    rng = random.Random(4)
    pieces = [("a", -2.0), ("ab", -2.5), ("abc", -2.5), ("c", -1.0), ("bca", -3.0)]
    word = "".join(rng.choice("abcé") for _ in range(200_000))
    counter = tokens.Counter(pieces)
    tracemalloc.start()
    got = counter.solve(word)
    assert tracemalloc.get_traced_memory()[1] < 4 * len(word) + 100_000  # the automaton copies the word, four bytes a character
    tracemalloc.stop()
    best, count = [0.0] + [None] * len(word), [0] * (len(word) + 1)
    of = dict(pieces)
    for end in range(1, len(word) + 1):
        for k in (3, 2, 1):
            piece = word[max(0, end - k) : end]
            score = of.get(piece, -13.0 if k == 1 and piece in "bé" else None) if len(piece) == k else None
            if score is not None and best[end - k] is not None and (best[end] is None or best[end - k] + score > best[end]):
                best[end], count[end] = best[end - k] + score, count[end - k] + (1 if piece in of else len(piece.encode()))
    assert got == complex(best[-1], count[-1])


def test_broadcasts_are_bounded_in_bytes(spark):
    df = spark.createDataFrame([("x" * 1000,), (None,), ("y" * 1000,)], "t string")
    hinted = lambda d: "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()
    assert hinted(small(df, size=F.octet_length("t"), most=2000)) and not hinted(small(df, size=F.octet_length("t"), most=1999))
    assert not hinted(small(df, 2, size=F.octet_length("t"))) and hinted(small(df.limit(0), size=F.octet_length("t")))
