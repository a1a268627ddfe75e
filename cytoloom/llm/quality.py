"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Every line has shape features (shares of capitals, symbols, digits, bars, word lengths,
repetition and so on), each in fixed bins, its own and those of the lines before and after.
The field labels lines good or bad, with weights for pairs of labels; forward-backward gives
each line's chance to be good, and their mean, weighted by line length, is the document's
score. Lines are trained with their document's label; where only some lines of a bad
document are bad, the pair weights decide how far they speak for the rest.

Texts are never cut. The fit reads a bounded sample of labelled documents (`sample`
whole documents), whose features alone go to the driver.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import restored, safe, table

#: Bins of a share: the edges between them.
EDGES = np.array([0.005, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.8])
BINS = len(EDGES) + 1
SHARES = ("upper", "symbol", "digit", "bar", "bang", "stop", "word_end_symbol", "repeated", "capital_word", "space")
FEATURES = (*SHARES, "word_length", "line_length")
#: Character classes, as bits, of code points below 592; others count as lower-case letters.
UPPER, LOWER, DIGIT, SPACE, STOP, SYMBOL, BAR, BANG = (1 << i for i in range(8))


def _classes() -> np.ndarray:
    out = np.zeros(593, np.uint8)
    for i in range(592):
        c = chr(i)
        out[i] = UPPER if c.isupper() else LOWER if c.isalpha() else DIGIT if c.isdigit() else SPACE if c.isspace() or i < 32 else STOP if c in ".,;:?'\"-()" else SYMBOL
    out[ord("|")] |= BAR
    out[ord("!")] |= BANG
    out[592] = LOWER
    return out


CLASS = _classes()
#: A hash of words: sums of these over a word's characters and places.
MIX = np.random.default_rng(7).integers(1, 2**62, 593, dtype=np.int64)


#: What is summed over a line's characters and words.
SUMS = ("upper", "symbol", "digit", "bar", "bang", "stop", "word_end_symbol", "repeated", "capital_word", "space", "marks", "words", "letters", "length")
#: Characters that are worked on at once.
PIECE = 250_000


@dataclass
class Open:
    """What a piece of a text leaves for the next: whether it ends inside a word, that word's hash and length so far, and the last whole word of the line."""

    inside: bool = False
    hash: int = 0
    length: int = 0
    last: tuple[int, int] | None = None


def line_sums(codes: np.ndarray, state: Open, more: bool = False) -> np.ndarray:
    """SUMS (lines x sums) of a piece of text, one line more than it has newlines. more: the character after the piece goes on with its last word."""
    cuts = np.flatnonzero(codes == 10)
    starts, ends = np.concatenate(([0], cuts + 1)), np.concatenate((cuts, [len(codes)]))
    small = np.minimum(codes, 592).astype(np.int64)
    kind = CLASS[small]

    def per_line(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return total[ends] - total[starts]

    space = (kind & SPACE) > 0
    inside = ~space
    word_start = inside & np.concatenate(([not state.inside], space[:-1]))[: len(codes)]
    word_end = inside & np.concatenate((space[1:], [not more]))[-len(codes) :] if len(codes) else inside
    at, to = np.flatnonzero(word_start), np.flatnonzero(word_end)
    total = np.concatenate(([0], np.cumsum(MIX[small] * inside, dtype=np.int64)))
    begun = np.concatenate(([0], at)) if state.inside else at
    whole = begun[: len(to)]
    word, size, line = total[to + 1] - total[whole], to + 1 - whole, np.searchsorted(cuts, to)
    carried = (np.int64(state.hash), state.length) if state.inside else (np.int64(0), 0)
    if len(to):
        with np.errstate(over="ignore"):
            word[0] += carried[0]
        size[0] += carried[1]
    same = np.zeros(len(to), bool)
    if len(to):
        same[1:] = (word[1:] == word[:-1]) & (size[1:] == size[:-1]) & (line[1:] == line[:-1])
        same[0] = state.last == (int(word[0]), int(size[0])) and line[0] == 0
    if len(begun) > len(to):  # the last word is open
        with np.errstate(over="ignore"):
            left = total[-1] - total[begun[-1]] + (carried[0] if not len(to) else np.int64(0))
        state.inside, state.hash, state.length = True, int(left), int(len(codes) - begun[-1] + (carried[1] if not len(to) else 0))
    else:
        state.inside = False
    if len(to) and line[-1] == len(cuts):
        state.last = int(word[-1]), int(size[-1])
    elif len(cuts):
        state.last = None
    bar, bang = (kind & BAR) > 0, (kind & BANG) > 0
    last = np.where(word_end, kind, 0)
    return np.stack(
        [
            per_line((kind & UPPER) > 0),
            per_line(((kind & SYMBOL) > 0) & ~bar & ~bang),
            per_line((kind & DIGIT) > 0),
            per_line(bar),
            per_line(bang),
            per_line((kind & STOP) > 0),
            per_line((last & SYMBOL) > 0),
            np.bincount(line[same], minlength=len(ends)),
            per_line(word_start & ((kind & UPPER) > 0)),
            per_line(space),
            per_line(inside),
            per_line(word_start),
            per_line((kind & (UPPER | LOWER)) > 0),
            ends - starts,
        ],
        axis=1,
    )


def binned(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bins of the features (lines x features, uint8) and lengths of the lines, a newline included."""
    v = dict(zip(SUMS, sums.T.astype(np.float64)))

    def share(of: str, by: str) -> np.ndarray:
        return v[of] / np.maximum(v[by], 1)

    values = [
        share("upper", "letters"),
        share("symbol", "marks"),
        share("digit", "marks"),
        share("bar", "words"),
        share("bang", "words"),
        share("stop", "marks"),
        share("word_end_symbol", "words"),
        share("repeated", "words"),
        share("capital_word", "words"),
        share("space", "length"),
        np.minimum(1.0, share("marks", "words") / 20),
        np.minimum(1.0, np.log1p(v["length"]) / 12),
    ]
    return np.stack([np.searchsorted(EDGES, x, side="right") for x in values], axis=1).astype(np.uint8), v["length"] + 1


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins (lines x features, uint8), lengths of the lines, and lines of each text. A text has a line more than it has newlines.

    Short texts go together; one longer than PIECE goes in pieces, so that beside some 20
    bytes a line no more is held than a piece takes.
    """
    n_lines = np.fromiter((t.count("\n") + 1 for t in texts), np.int64, len(texts))
    code = lambda t: np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for run in _chunks(texts, PIECE):
        if len(run) > 1 or len(run[0]) <= PIECE:
            found.append(binned(line_sums(code("\n".join(run)), Open())))
            continue
        text, state, rest = run[0], Open(), np.zeros((1, len(SUMS)), np.int64)
        for i in range(0, len(text), PIECE):
            after = text[i + PIECE : i + PIECE + 1]
            sums = line_sums(code(text[i : i + PIECE]), state, bool(after) and not CLASS[min(ord(after), 592)] & SPACE)
            sums[0] += rest[0]
            rest = sums[-1:]
            found.append(binned(sums[:-1]))
        found.append(binned(rest))
    return np.concatenate([x for x, _ in found]), np.concatenate([n for _, n in found]), n_lines


def with_neighbours(bins: np.ndarray, n_lines: np.ndarray) -> np.ndarray:
    """Bins of a line, of the one before and of the one after; BINS stands for no line."""
    ends = np.cumsum(n_lines)
    before, after = np.full_like(bins, BINS), np.full_like(bins, BINS)
    before[1:], after[:-1] = bins[:-1], bins[1:]
    before[ends - n_lines], after[ends - 1] = BINS, BINS
    return np.concatenate((bins, before, after), axis=1)


@dataclass
class Field:
    """weights: for each feature and bin; pairs[a, b]: from label a to b; start and end: of the labels. Labels: 0 bad, 1 good."""

    weights: np.ndarray
    bias: float
    pairs: np.ndarray
    start: np.ndarray
    end: np.ndarray

    @staticmethod
    def blank() -> Field:
        return Field(np.zeros((3 * len(FEATURES), BINS + 1)), 0.0, np.zeros((2, 2)), np.zeros(2), np.zeros(2))

    def emission(self, x: np.ndarray) -> np.ndarray:
        """Score of good over bad for each line."""
        out = np.empty(len(x))
        for i in range(0, len(x), 65_536):
            part = x[i : i + 65_536]
            out[i : i + len(part)] = self.weights[np.arange(x.shape[1]), part].sum(axis=1) + self.bias
        return out

    def marginals(self, x: np.ndarray, n_lines: np.ndarray, pairs: bool = True):
        """P(good) of every line; expected label pairs, by document; log of the partition function. Without pairs only the first."""
        e = self.emission(x)
        psi = np.stack((np.exp(-e / 2 - np.abs(e) / 2), np.exp(e / 2 - np.abs(e) / 2)), axis=1)
        shift = (e + np.abs(e)) / 2
        pair, first, last = np.exp(self.pairs), np.exp(self.start), np.exp(self.end)
        order = np.argsort(-n_lines, kind="stable")
        at = (np.cumsum(n_lines) - n_lines)[order]
        n = n_lines[order]
        longest = int(n[0]) if len(n) else 0
        live = np.searchsorted(-n, -np.arange(longest), side="left")  # documents longer than t
        alpha, beta = np.empty_like(psi), np.empty_like(psi)
        scale = np.empty(len(psi))
        for t in range(longest):
            rows = at[: live[t]] + t
            a = (alpha[rows - 1] @ pair if t else first) * psi[rows]
            scale[rows] = s = a.sum(axis=1)
            alpha[rows] = a / s[:, None]
        ends = at + n - 1
        beta[ends] = last
        for t in range(longest - 2, -1, -1):
            rows = at[: live[t + 1]] + t
            b = (psi[rows + 1] * beta[rows + 1]) @ pair.T
            beta[rows] = b / b.sum(axis=1)[:, None]
        both = alpha * beta
        both /= both.sum(axis=1)[:, None]
        if not pairs:
            return both[:, 1], None, None
        inner = np.ones(len(psi), bool)
        inner[ends] = False
        i = np.flatnonzero(inner)
        joint = alpha[i][:, :, None] * pair[None] * (psi[i + 1] * beta[i + 1])[:, None, :]
        joint /= joint.sum(axis=(1, 2))[:, None, None]
        z = np.log(scale).sum() + shift.sum() + np.log((alpha[ends] * last).sum(axis=1)).sum()
        return both[:, 1], joint, z

    def scores(self, x: np.ndarray, lengths: np.ndarray, n_lines: np.ndarray) -> np.ndarray:
        good, _, _ = self.marginals(x, n_lines, pairs=False)
        at = np.cumsum(n_lines) - n_lines
        return np.clip(np.add.reduceat(good * lengths, at) / np.add.reduceat(lengths, at), 0.0, 1.0)


def fit(x: np.ndarray, n_lines: np.ndarray, labels: np.ndarray, steps: int = 200, rate: float = 0.1, l2: float = 1e-3) -> Field:
    """Maximum likelihood with a quadratic penalty, by Adam over the whole sample. Documents weigh alike whatever their number of lines."""
    field = Field.blank()
    if not len(labels):
        return field
    y = np.repeat(labels, n_lines).astype(np.float64)
    weight = np.repeat(1.0 / n_lines, n_lines)
    at = np.cumsum(n_lines) - n_lines
    ends = at + n_lines - 1
    inner = np.ones(len(y), bool)
    inner[ends] = False
    i = np.flatnonzero(inner)
    gold = np.zeros((len(i), 2, 2))
    gold[np.arange(len(i)), y[i].astype(int), y[i + 1].astype(int)] = 1
    docs = float(len(labels))
    columns = np.arange(x.shape[1])
    theta = [field.weights, np.zeros(1), field.pairs, field.start, field.end]
    m, v = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    for step in range(1, steps + 1):
        field.bias = float(theta[1][0])
        good, joint, _ = field.marginals(x, n_lines)
        off = (y - good) * weight / docs
        g = np.zeros_like(field.weights)
        for c in columns:
            g[c] = np.bincount(x[:, c], off, minlength=BINS + 1)
        label = lambda p, w: np.array([((1 - p) * w).sum(), (p * w).sum()])
        edge = np.ones(len(labels)) / docs
        grads = [
            g,
            np.array([off.sum()]),
            ((gold - joint) * weight[i][:, None, None]).sum(axis=0) / docs,
            label(y[at], edge) - label(good[at], edge),
            label(y[ends], edge) - label(good[ends], edge),
        ]
        for k, (t, grad) in enumerate(zip(theta, grads)):
            grad = grad - l2 * t / 10
            m[k] = 0.9 * m[k] + 0.1 * grad
            v[k] = 0.999 * v[k] + 0.001 * grad**2
            t += rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    field.bias = float(theta[1][0])
    return field


def _chunks(texts: Iterable[str | None], limit: int = PIECE):
    """Runs of whole texts of about so many characters together; a longer text is a run of its own."""
    run, n = [], 0
    for t in texts:
        t = t or ""
        if run and n + len(t) > limit:
            yield run
            run, n = [], 0
        run.append(t)
        n += len(t)
    if run:
        yield run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = 4000, usable=None) -> Field:
    """Fits a Field to labelled documents: the first `sample` of them by a hash of the id, with all their lines.

    Rows of labels without an id or label don't count; of several labels of an id the
    smallest holds, of several texts too. usable: a condition on the id column for those to learn from.
    """
    known = labels.select(F.col(id_col), F.col(label_col).alias("y")).where(F.col(id_col).isNotNull() & F.col("y").isNotNull())
    if usable is not None:
        known = known.where(usable)
    known = known.groupBy(id_col).agg(F.min("y").alias("y"))
    chosen = known.orderBy(F.xxhash64(id_col), id_col).limit(sample)  # bounded by `sample`
    rows = docs.select(F.col(id_col), F.col(text_col).alias("t")).join(F.broadcast(chosen), id_col)
    rows = rows.groupBy(id_col).agg(F.min("t").alias("t"), F.min("y").alias("y"))

    def features(batches):
        for batch in batches:
            out, sizes = [], []
            for run in _chunks(t.as_py() for t in batch.column(1)):
                bins, _, n_lines = line_features(run)
                x = with_neighbours(bins, n_lines)
                for a, n in zip(np.cumsum(n_lines) - n_lines, n_lines):
                    out.append(x[a : a + n].tobytes())
                    sizes.append(int(n))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(out, pa.binary())], names=["id", "y", "n", "x"])

    id_type = docs.select(id_col).schema.fields[0].dataType
    got = rows.select(id_col, "t", F.col("y").cast("long")).mapInArrow(features, T.StructType([T.StructField("id", id_type), T.StructField("y", T.LongType()), T.StructField("n", T.LongType()), T.StructField("x", T.BinaryType())])).collect()
    got = sorted(got, key=lambda r: r["id"])
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in got), np.uint8).reshape(-1, 3 * len(FEATURES))
    return fit(x, np.array([r["n"] for r in got], np.int64), np.array([int(r["y"] > 0) for r in got]))


def score(df: DataFrame, field: Field, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """df (or its columns `keep`) with score: the length-weighted chance that its lines are good.

    A null text is an empty one, which is a single empty line. Texts are read whole: long
    ones in pieces, whose sums by line are joined, and a worker holds some hundred bytes for
    each line of a document. Repeated rows give repeated results; an empty table gives an
    empty result. Columns pass through; one called score is replaced.
    """
    columns = df.columns if keep is None else keep
    rows = df.select(*safe(df, columns), F.col(text_col).alias("__text"))
    keep = [f"__c{i}" for i in range(len(columns))]
    shared = df.sparkSession.sparkContext.broadcast((field.weights, field.bias, field.pairs, field.start, field.end))

    def run(batches):
        here = Field(*shared.value)
        for batch in batches:
            found = []
            for texts in _chunks(t.as_py() for t in batch.column(len(keep))):
                bins, lengths, n_lines = line_features(texts)
                found.append(here.scores(with_neighbours(bins, n_lines), lengths, n_lines))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())], names=[*keep, "score"])

    schema = T.StructType([*rows.select(*keep).schema.fields, T.StructField("score", T.DoubleType())])
    return restored(rows.mapInArrow(run, schema), columns, ["score"])


def fold(c):
    """crc32 of the id as text, mod 3; a null id is in fold 0."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % 3


def op7_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = train(docs, table(spark, sf_dir, "labels"), usable=fold(F.col("doc_id")) != 1)
    return score(docs, field, keep=["doc_id"]).select("doc_id", (fold(F.col("doc_id")) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
