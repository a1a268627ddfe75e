"""Token counts by a count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists the vocabulary's matches by their end, longest first. The
dynamic program keeps, for each end, the best score and the number of pieces on the best
path; no path is stored. Ties follow the tokenizer: scores of a place are compared in the
order in which paths begin, and only a strictly better one replaces another, so the longest
last piece wins. A character that no single piece covers may be unknown, at the least score
minus 10; unknown characters count as their UTF-8 bytes (byte fallback).

No piece of the vocabulary has a word mark after another character, so words are
independent: the best path of a text is that of its words, and a word's result is kept for
its next occurrence. Where a vocabulary has such pieces, whole texts are solved instead.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import restored, safe, table

MARK = "▁"
PENALTY = 10.0
#: Words that a worker remembers.
REMEMBERED = 400_000


def load(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a SentencePiece file that match text: not control, unknown or byte pieces."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    kinds = pb.ModelProto.SentencePiece
    return [(p.piece, p.score) for p in model.pieces if p.type in (kinds.NORMAL, kinds.USER_DEFINED)]


class Counter:
    """Counts pieces of texts; results are complex numbers of score and count, which add up as such."""

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.longest = max(len(p) for p, _ in pieces)
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.unknown = min(s for _, s in pieces) - PENALTY
        self.by_word = not any(re.search(f"[^{MARK}]{MARK}", p) for p, _ in pieces)
        self.by_line = self.by_word and not any("\n" in p for p, _ in pieces)
        self.words: dict[str, complex] = {}

    def solve(self, s: str) -> complex:
        """Best score and piece count of a normalised string, from a window of as many places as the longest piece spans."""
        n, single, unknown, w = len(s), self.single, self.unknown, min(self.longest, len(s)) + 1
        best: list[float | None] = [None] * w
        count = [0] * w
        best[0], at = 0.0, 0

        def close() -> None:
            """The unknown edge into the place comes last, as it begins last."""
            c, before, here = s[at - 1], (at - 1) % w, at % w
            if c not in single and best[before] is not None:
                x = best[before] + unknown
                if best[here] is None or x > best[here]:
                    best[here], count[here] = x, count[before] + len(c.encode("utf-8", "surrogatepass"))

        for end, (length, score) in self.automaton.iter(s):
            while at <= end:
                if at:
                    close()
                at += 1
                best[at % w] = None
            start, here = (at - length) % w, at % w
            if best[start] is None:
                continue
            x = best[start] + score
            if best[here] is None or x > best[here]:
                best[here], count[here] = x, count[start] + 1
        while at < n:
            if at:
                close()
            at += 1
            best[at % w] = None
        if n:
            close()
        return complex(best[n % w], count[n % w])

    def word(self, s: str) -> complex:
        got = self.words.get(s)
        if got is None:
            if len(self.words) >= REMEMBERED:
                self.words.clear()
            got = self.solve(s)
            if len(s) <= 64:
                self.words[s] = got
        return got

    def text(self, text: str | None) -> complex:
        """Null and empty texts have no tokens. Others get a word mark in front; spaces are word marks."""
        if not text:
            return 0j
        text = " " + text.replace(MARK, " ")
        if not self.by_word:
            return self.solve(text.replace(" ", MARK))
        total, word = 0j, self.word
        lines = text.split("\n") if self.by_line else [text]
        total += complex(self.unknown, 1) * (len(lines) - 1)
        for line in lines:
            if "  " in line or line.endswith(" "):
                for s in re.findall(" +[^ ]*|[^ ]+", line):
                    total += word(s.replace(" ", MARK))
                continue
            head, *rest = line.split(" ")
            if head:
                total += word(head)
            for w in rest:
                total += word(MARK + w)
        return total


def count_tokens(df: DataFrame, pieces: list[tuple[str, float]], text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """df (or its columns `keep`) with n_tokens and score (of the best path), from whole texts.

    Null and empty texts have no tokens and score 0; repeated rows give repeated results; an
    empty table gives an empty result. A word's time grows with its length and its matches,
    a text's with its words, however long it is. Of paths equally good the one whose last
    piece is longest wins, as in the tokenizer. The vocabulary is broadcast; its size is that
    of the file. Columns of df of the added names are replaced, others pass through.
    """
    columns = df.columns if keep is None else keep
    rows = df.select(*safe(df, columns), df[text_col].alias("__text"))
    keep = [f"__c{i}" for i in range(len(columns))]
    vocabulary = df.sparkSession.sparkContext.broadcast(pieces)

    def run(batches):
        counter = Counter(vocabulary.value)
        for batch in batches:
            got = [counter.text(t.as_py()) for t in batch.column(len(keep))]
            new = [pa.array([round(x.imag) for x in got], pa.int64()), pa.array([x.real for x in got], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *new], names=[*keep, "n_tokens", "score"])

    schema = T.StructType([*rows.select(*keep).schema.fields, T.StructField("n_tokens", T.LongType()), T.StructField("score", T.DoubleType())])
    return restored(rows.mapInArrow(run, schema), columns, ["n_tokens", "score"])


def op5_tokens(spark, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_tokens and score of all documents under the public vocabulary of 32,000 pieces."""
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("piece_bpe_32k.model")
    return count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), load(str(vocabulary)), keep=["doc_id"])
