"""License scans: identifier tags and notice phrases by Aho-Corasick, licence expressions by shunting-yard.

One automaton over a text's words, joined by single spaces, lists every place where the words
of a notice phrase or of an identifier tag stand consecutively. What follows a tag on its
line ("SPDX-License-Identifier: (MIT OR Apache-2.0) AND Zlib") is an expression; so are
notices of a text that words like "or" and "and" alone stand between ("the MIT License or the
Apache License, Version 2.0"). A shunting-yard parser turns an expression into postfix order,
in which `with` binds tightest and `or` least, and it is evaluated to how free its terms are:
`and` asks for all terms, so takes the least; `or` leaves the choice, so takes the greatest;
`with` an exception lifts copyleft to that of a library.

All expressions of a text hold together, so its score is the least of them: 1 for public
domain, 0.9 for permissive licences, 0.6 for weak copyleft, 0.4 for strong and 0.3 for network
copyleft, 0.1 where commercial use or changes are excluded, 0 for terms that aren't known, and
for texts without any, which grant nothing.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import restored, safe, table
from .decontaminate import FOLD

#: Phrases of the query's contract, and the labels of their places. (fixed values)
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
#: Notice phrases, as words, and their labels. (fixed values: names and wording of public licences)
NOTICES = (
    ("mit license", "mit"), ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("apache license", "apache"), ("apache license version 1 1", "apache-1.1"), ("apache license version 2", "apache-2"), ("apache license 2 0", "apache-2"),
    ("bsd license", "bsd"), ("2 clause bsd license", "bsd-2-clause"), ("3 clause bsd license", "bsd-3-clause"), ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("isc license", "isc"), ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("zlib license", "zlib"), ("boost software license", "bsl"), ("boost software license version 1 0", "bsl-1"), ("python software foundation license", "psf"), ("sil open font license", "ofl"),
    ("gnu general public license", "gpl"), ("gnu general public license version 2", "gpl-2"), ("gnu general public license version 3", "gpl-3"), ("gnu gpl", "gpl"), ("gnu gpl v2", "gpl-2"), ("gnu gpl v3", "gpl-3"),
    ("gnu lesser general public license", "lgpl"), ("gnu lesser general public license version 2 1", "lgpl-2.1"), ("gnu lesser general public license version 3", "lgpl-3"), ("gnu library general public license", "lgpl"),
    ("gnu affero general public license", "agpl"), ("gnu affero general public license version 3", "agpl-3"),
    ("mozilla public license", "mpl"), ("mozilla public license version 2", "mpl-2"), ("mozilla public license 2 0", "mpl-2"), ("eclipse public license", "epl"), ("common development and distribution license", "cddl"),
    ("cc by", "cc-by"), ("cc by sa", "cc-by-sa"), ("cc by nc", "cc-by-nc"), ("cc by nd", "cc-by-nd"), ("cc by nc sa", "cc-by-nc-sa"), ("cc by nc nd", "cc-by-nc-nd"), ("cc0", "cc0"),
    ("creative commons attribution", "cc-by"), ("creative commons attribution sharealike", "cc-by-sa"), ("creative commons attribution noncommercial", "cc-by-nc"), ("creative commons attribution noderivatives", "cc-by-nd"), ("creative commons zero", "cc0"),
    ("this is free and unencumbered software released into the public domain", "unlicense"), ("released into the public domain", "public-domain"), ("dedicated to the public domain", "public-domain"),
)
#: Exceptions that may follow `with`, as words. (fixed values)
EXCEPTIONS = (("classpath exception", "classpath-exception"), ("linking exception", "linking-exception"), ("gcc runtime library exception", "gcc-exception"), ("autoconf exception", "autoconf-exception"), ("llvm exception", "llvm-exception"))
#: Identifier tags, as words; after the first any licence is taken, after the others only known ones. (fixed values)
TAGS = ("spdx license identifier", "license", "licence", "license expression")
#: Families of licences by how free they are; the longest that an identifier begins with holds. (fixed values)
FREEDOM = {
    1.0: ("cc0", "unlicense", "0bsd", "public-domain", "wtfpl"),
    0.9: ("mit", "apache", "bsd", "isc", "zlib", "bsl", "psf", "python", "ofl", "cc-by", "x11", "ncsa"),
    0.6: ("lgpl", "mpl", "epl", "cddl"),
    0.4: ("gpl", "cc-by-sa", "eupl"),
    0.3: ("agpl", "sspl"),
    0.1: ("cc-by-nc", "cc-by-nd", "proprietary"),
}
FAMILY = {family: free for free, of in FREEDOM.items() for family in of}
WEAK = 0.6
#: Words that may stand between two notices of one expression, beside one of its operators.
BETWEEN = frozenset("either both the a an under terms of license licence licenses version v 0 1 2 3 4 only".split())
TIGHT = {"or": 1, "and": 2, "with": 3}

OPENS = re.compile(rb"""["']?[\x20\t]*[:=][\x20\t]*["']?""")
TOKEN = re.compile(rb"[\x20\t]*([()]|[A-Za-z0-9][A-Za-z0-9.+:-]*)")


def label_of(identifier: str) -> str:
    """The label of a licence identifier: lower case, without 'or later', 'only' and a zero minor version; Creative Commons without any version."""
    s = re.sub(r"(\+|-only|-or-later)$", "", identifier.lower().rstrip(".:"))
    s = re.sub(r"(-\d+)\.0$", r"\1", s)
    return re.sub(r"-\d+(\.\d+)*$", "", s) if s.startswith("cc-by") else "cc0" if s.startswith("cc0-") else s


def freedom(label: str) -> float | None:
    """How free a label's terms are; None if they aren't known."""
    parts = label.split("-")
    return next((FAMILY[f] for k in range(len(parts), 0, -1) if (f := "-".join(parts[:k])) in FAMILY), None)


def continuing(run, known_only: bool = False) -> list[str]:
    """The tokens of a run up to the first that can't go on with an expression; identifiers as labels.

    Operators at the end, without a right side, are left out, and so are parentheses left
    open with nothing in them; other open parentheses close at the end.
    """
    out: list[str] = []
    depth, operand = 0, True
    for t in run:
        low = t.lower()
        if operand and t == "(" and out[-1:] != ["with"]:
            depth += 1
        elif operand and t not in "()" and low not in TIGHT:
            low = label_of(t)
            if known_only and freedom(low) is None and out[-1:] != ["with"]:
                break
            operand = False
        elif not operand and low in TIGHT:
            operand = True
        elif not operand and t == ")" and depth:
            depth -= 1
        else:
            break
        out.append(low)
    while out and (out[-1] in TIGHT or out[-1] == "("):
        depth -= out.pop() == "("
    return out + [")"] * depth


def postfix(expression: list[str]) -> list[str]:
    """Shunting-yard: a well-formed expression in postfix order."""
    out, waiting = [], []
    for t in expression:
        if t == "(":
            waiting.append(t)
        elif t == ")":
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
        elif t in TIGHT:
            while waiting and waiting[-1] != "(" and TIGHT[waiting[-1]] >= TIGHT[t]:
                out.append(waiting.pop())
            waiting.append(t)
        else:
            out.append(t)
    return out + waiting[::-1]


def evaluate(order: list[str]) -> tuple[float, list[str]]:
    """Freedom of an expression in postfix order, and the labels of its licences (exceptions are none)."""
    stack: list[float] = []
    for i, t in enumerate(order):
        if t not in TIGHT:
            stack.append(freedom(t) or 0.0)
            continue
        b, a = stack.pop(), stack.pop()
        if t == "with":  # its right side is one exception, just before
            stack.append(max(a, WEAK) if a in (0.3, 0.4) and "exception" in order[i - 1] else a)
        else:
            stack.append((min if t == "and" else max)(a, b))
    return stack[0], [t for t, after in zip(order, [*order[1:], ""]) if t not in TIGHT and after != "with"]


def tokens(text: bytes, at: int):
    """Tokens from a place on, one by one, as an expression mostly ends long before they do."""
    while token := TOKEN.match(text, at):
        yield token[1].decode()
        at = token.end()


class Scanner:
    """Finds the places of all phrases and tags of a text and evaluates its expressions."""

    def __init__(self):
        import ahocorasick

        named: dict[str, list] = {}
        for kind, phrases in (("base", BASE), ("notice", NOTICES), ("exception", EXCEPTIONS), ("tag", [(t, t) for t in TAGS])):
            for phrase, label in phrases:
                named.setdefault(phrase, []).append((kind, label))
        self.automaton = ahocorasick.Automaton()
        for phrase, of in named.items():
            self.automaton.add_word(f" {phrase} ", (len(phrase.split()), of))
        self.automaton.make_automaton()

    def text(self, text: bytes | None) -> tuple[int, list[tuple[str, int]], list[str], list[str], float]:
        """(words, base places (label, first word), labels, expressions, score)."""
        folded = (text or b"").translate(FOLD)
        words = folded.split()
        joined = f" {b' '.join(words).decode('latin-1')} "  # a byte a character; the phrases are ASCII
        base, notices, tags = [], [], []
        before = at = 0
        for end, (n, of) in self.automaton.iter(joined):
            before, at = before + joined.count(" ", at, end), end
            for kind, label in of:
                (base if kind == "base" else tags if kind == "tag" else notices).append((before - n, before, kind, label))
        found = [continuing(run, known) for run, known in self._tagged(text, folded, tags)] + self._chains(words, longest(notices + base))
        values = [evaluate(postfix(e)) for e in found if e]
        labels = {label for *_, label in base}.union(*[of for _, of in values]) if values else {label for *_, label in base}
        return len(words), [(label, a) for a, _, _, label in sorted(base)], sorted(labels), [" ".join(e) for e in found if e], min((v for v, _ in values), default=0.0)

    @staticmethod
    def _tagged(text: bytes | None, folded: bytes, tags: list):
        """(tokens, whether they must be known) after each tag that a colon or equals sign follows."""
        if not tags:
            return
        wanted = {b - 1: label for _, b, _, label in tags}
        last = max(wanted)
        for i, word in enumerate(re.finditer(rb"[^ ]+", folded)):
            if i in wanted and (opens := OPENS.match(text, word.end())):
                yield tokens(text, opens.end()), wanted[i] != TAGS[0]
            if i == last:
                return

    @staticmethod
    def _chains(words: list[bytes], places: list) -> list[list[str]]:
        """Expressions of notices; places are in order and apart."""
        out: list[list[str]] = []
        end = None
        for a, b, kind, label in places:
            # the words of the longest chain are some few, so a gap that is longer isn't read
            gap = [w.decode("latin-1") for w in words[end:a]] if end is not None and a - end <= 8 else None
            joins = [w for w in gap if w in TIGHT] if gap is not None else []
            if len(joins) == 1 and all(w in BETWEEN or w in TIGHT for w in gap) and (joins[0] == "with") == (kind == "exception"):
                out[-1] += [joins[0], label]
            elif kind != "exception":
                out.append([label])
            else:
                continue
            end = b
        return out


def longest(places: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """Places in order, without those within or across an earlier or longer one, one for each place."""
    out: list = []
    for p in sorted(places, key=lambda p: (p[0], -p[1], p[3])):
        if not out or p[0] >= out[-1][1]:
            out.append(p)
    return out


def scan(df: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """df (or its columns `keep`) with n_words, base, labels, expressions and score.

    base has the places (label, start) of the contract's phrases, in order, all of them,
    overlapping ones too; starts count words from 0. labels are those of base and of all
    expressions, distinct and sorted; expressions are those after tags, then those of
    notices, in order. Of notices that overlap the one that begins first holds, of several
    the longest. A malformed expression counts up to the token that can't go on.

    A null text is empty; repeated rows give repeated results; an empty table gives an empty
    one. Texts are read whole, in time that grows with their length. Columns of df of the
    added names are replaced, others pass through.
    """
    columns = df.columns if keep is None else keep
    rows = df.select(*safe(df, columns), df[f"`{text_col}`"].cast("binary").alias("__text"))
    keep = [f"__c{i}" for i in range(len(columns))]
    place = pa.struct([("label", pa.string()), ("start", pa.int64())])
    names = ["n_words", "base", "labels", "expressions", "score"]

    def run(batches):
        scanner = Scanner()
        for batch in batches:
            got = [scanner.text(t.as_py()) for t in batch.column(len(keep))]
            n, base, labels, expressions, score = zip(*got) if got else [()] * 5
            places = [[{"label": label, "start": start} for label, start in of] for of in base]
            new = [pa.array(n, pa.int64()), pa.array(places, pa.list_(place)), pa.array(labels, pa.list_(pa.string())), pa.array(expressions, pa.list_(pa.string())), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *new], names=[*keep, *names])

    strings = T.ArrayType(T.StringType())
    types = (T.LongType(), T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.LongType())])), strings, strings, T.DoubleType())
    schema = T.StructType([*rows.select(*keep).schema.fields, *[T.StructField(n, t) for n, t in zip(names, types)]])
    return restored(rows.mapInArrow(run, schema), columns, names)


def op11_licenses(spark, sf_dir: str) -> DataFrame:
    rows = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    starts = F.transform("base", lambda p: p["start"])
    return rows.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("base", lambda p: p["label"]))), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        F.array_join("expressions", "; ").alias("expressions"),
        "score",
    )
