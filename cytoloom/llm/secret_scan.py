"""Secret scans in DataFrame and SQL operations only.

Base kinds are regular expressions with their positions: the matches of a pattern and the
gaps between them, taken from one text in turn, give every start and end in code points.

The method beside them looks for random-looking strings that no pattern names. Candidates
are long runs of key characters. A window slides over a candidate; the counts of its
characters, packed into whole numbers, change by one in and one out at each step, and with
them the sum of c*log2(c), so the window's Shannon entropy log2(w) - sum/w is known at each
step without counting again. The threshold depends on the candidate's character class.
Candidates that as a whole match an allow-list pattern (words, numbers, UUIDs) are
suppressed; windows that hold an allowed string (placeholders, alphabets, runs of one
character) are suppressed alone, so that a key beside one is still found. The sum is kept in
whole millionths, so results are the same everywhere.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

#: Kinds in the order of the contract. The patterns of access and hex match just the runs of the contract's patterns that are long enough.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST = 6
#: Candidates of the entropy windows, their alphabet, and by class (pattern of the whole candidate) the least entropy in bits a character.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
CLASSES = ((r"^[0-9a-fA-F]+$", 3.0), (r"^[A-Z2-7=]+$", 3.5), (r".", 3.75))
#: Allow-list of whole candidates, and of strings that a hot window may not hold.
ALLOWED = (
    r"^[A-Za-z+/_=-]+$",
    r"^[0-9+/_=-]+$",
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
)
ALLOWED_INSIDE = (
    r"(?i)example|placeholder|changeme|dummy|sample|xxxx|your[_-]",
    r"(?i)abcdefgh|01234567|12345678",
    r"(.)\1{5,}",
)
#: Counts of a window are of 5 bits each, so many to a number.
PACKED = 12


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def spans_sql(gaps: str, lengths: str) -> str:
    """SQL for an array of (b, e): gaps are the texts between matches, lengths those of the matches in turn.

    Running sums go in blocks of about the root of the number of matches, as an append copies
    its array: m matches take m ** 1.5 copied elements, not m ** 2.
    """
    pairs = f"filter(zip_with({gaps}, {lengths}, (g, m) -> named_struct('g', length(g), 'm', m)), x -> x.m IS NOT NULL)"
    none = "cast(array() as array<struct<b:int,e:int>>)"
    block = (
        f"aggregate(slice(z.p, cast(j * z.w + 1 as int), z.w), named_struct('p', a.p, 'o', {none}), "
        "(s, x) -> named_struct('p', s.p + x.g + x.m, 'o', array_append(s.o, named_struct('b', s.p + x.g, 'e', s.p + x.g + x.m))))"
    )
    whole = f"aggregate(sequence(0, cast((size(z.p) - 1) div z.w as int)), named_struct('p', 0, 'o', {none}), (a, j) -> transform(array({block}), s -> named_struct('p', s.p, 'o', concat(a.o, s.o)))[0], a -> a.o)"
    return f"transform(transform(array({pairs}), p -> named_struct('p', p, 'w', cast(ceil(sqrt(size(p) + 1)) as int))), z -> {whole})[0]"


def hot_window_sql(c: str) -> str:
    """SQL for (first, last) of the windows of candidate c whose entropy reaches its class's threshold and that hold no allowed string, 0-based and end exclusive; first is null if none does."""
    table_ = ", ".join(f"{round(n * math.log2(n) * 1e6) if n else 0}L" for n in range(WINDOW + 2))
    most = " ".join(f"WHEN {c} RLIKE {_lit(p)} THEN {math.floor((math.log2(WINDOW) - h) * WINDOW * 1e6)}L" for p, h in CLASSES)
    fields = -(-len(ALPHABET) // PACKED)
    # i, o: the codes that come in and go out (-1: none); ni, no: their counts in the window before
    count = lambda x: f"cast(shiftright(a.n[cast({x} div {PACKED} as int)], cast({x} % {PACKED} * 5 as int)) & 31 as int)"
    one = lambda x: f"CASE WHEN f = {x} div {PACKED} AND {x} >= 0 THEN shiftleft(1L, cast({x} % {PACKED} * 5 as int)) ELSE 0L END"
    moved = f"transform(array(named_struct('i', z.k[j], 'o', CASE WHEN j >= {WINDOW} THEN z.k[j - {WINDOW}] ELSE -1 END)), x -> named_struct('i', x.i, 'o', x.o, 'ni', {count('x.i')}, 'no', CASE WHEN x.o < 0 THEN 0 ELSE {count('x.o')} END))"
    step = (
        f"transform({moved}, u -> named_struct('n', CASE WHEN u.i = u.o THEN a.n ELSE transform(a.n, (v, f) -> v + {one('u.i')} - {one('u.o')}) END, "
        "'s', a.s + CASE WHEN u.i = u.o THEN 0L ELSE z.f[u.ni + 1] - z.f[u.ni] + CASE WHEN u.o < 0 THEN 0L ELSE z.f[u.no - 1] - z.f[u.no] END END, "
        "'first', a.first, 'last', a.last))"
    )
    inside = " OR ".join(f"substring(z.c, j - {WINDOW - 2}, {WINDOW}) RLIKE {_lit(p)}" for p in ALLOWED_INSIDE)
    seen = f"transform({step}, s -> CASE WHEN j >= {WINDOW - 1} AND s.s <= z.most AND NOT ({inside}) THEN named_struct('n', s.n, 's', s.s, 'first', coalesce(s.first, j - {WINDOW - 1}), 'last', j + 1) ELSE s END)[0]"
    walk = f"aggregate(sequence(0, size(z.k) - 1), named_struct('n', array_repeat(0L, {fields}), 's', 0L, 'first', cast(null as int), 'last', cast(null as int)), (a, j) -> {seen}, a -> named_struct('first', a.first, 'last', a.last))"
    codes = f"transform(filter(split({c}, ''), h -> h <> ''), h -> instr({_lit(ALPHABET)}, h) - 1)"
    return f"transform(array(named_struct('c', {c}, 'k', {codes}, 'f', array({table_}), 'most', CASE {most} END)), z -> {walk})[0]"


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and findings: an array of (start, rank, kind, end), sorted, for each row of df.

    Kinds are assign, access, hex and entropy, spans in code points with the end excluded.
    A null text is empty; an empty table gives an empty result. Repeated rows give repeated
    results. Texts are scanned whole, in a time that grows with their length and, where they
    hold m matches, with m ** 1.5 short steps. Findings that begin at one place are ordered
    by kind; spans of different kinds may overlap. Other columns are not read.
    """
    rows = df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    a, x, h, c = map(_lit, (ASSIGN, ACCESS, HEX, CANDIDATE))
    none = "cast(array() as array<struct<start:int,rank:int,kind:string,end:int>>)"
    rows = rows.select(
        id_col,
        "t",
        F.expr(f"regexp_extract_all(t, {a}, 0)").alias("am"),
        F.expr(f"CASE WHEN contains(t, 'AKIA') THEN regexp_extract_all(t, {x}, 0) ELSE cast(array() as array<string>) END").alias("xm"),
        F.expr(f"regexp_extract_all(t, {h}, 0)").alias("hm"),
        F.expr(f"regexp_extract_all(t, {c}, 0)").alias("cm"),
    )

    def found(kind: str, rank: int, pattern: str, column: str) -> str:
        spans = spans_sql(f"split(t, {pattern}, -1)", f"transform({column}, m -> length(m))")
        return f"CASE WHEN size({column}) = 0 THEN {none} ELSE transform({spans}, s -> named_struct('start', s.b, 'rank', {rank}, 'kind', '{kind}', 'end', s.e)) END"

    assign = spans_sql(f"split(t, {a}, -1)", "transform(am, m -> length(m))")
    kept = f"transform(filter(arrays_zip({assign} as s, regexp_extract_all(t, {a}, 2) as g), v -> length(v.g) >= {LEAST}), v -> named_struct('start', v.s.b, 'rank', 1, 'kind', 'assign', 'end', v.s.e))"
    kept = kept.replace(f"arrays_zip({assign} as s, regexp_extract_all(t, {a}, 2) as g)", f"zip_with({assign}, regexp_extract_all(t, {a}, 2), (s, g) -> named_struct('s', s, 'g', g))")
    allowed = " OR ".join(f"m RLIKE {_lit(p)}" for p in ALLOWED)
    windows = f"transform(cm, m -> CASE WHEN {allowed} THEN named_struct('first', cast(null as int), 'last', cast(null as int)) ELSE {hot_window_sql('m')} END)"
    entropy = f"transform(filter(zip_with({spans_sql(f'split(t, {c}, -1)', 'transform(cm, m -> length(m))')}, {windows}, (s, w) -> named_struct('s', s, 'w', w)), v -> v.w.first IS NOT NULL), v -> named_struct('start', v.s.b + v.w.first, 'rank', 4, 'kind', 'entropy', 'end', v.s.b + v.w.last))"
    return rows.select(
        id_col,
        F.expr(f"array_sort(concat(CASE WHEN size(am) = 0 THEN {none} ELSE {kept} END, {found('access', 2, x, 'xm')}, {found('hex', 3, h, 'hm')}, CASE WHEN NOT exists(cm, m -> NOT ({allowed})) THEN {none} ELSE {entropy} END))").alias("findings"),
    )


def op2_secrets(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    text = "array_join(transform({}, f -> concat(f.kind, ':', f.start, ':', f.end)), ',')"
    count = "cast(size(filter(findings, f -> f.kind = '{}')) as bigint)"
    return found.select(
        "doc_id",
        *[F.expr(count.format(k)).alias(f"n_{k}") for k in ("assign", "access", "hex", "entropy")],
        F.expr(f"sha2(cast({text.format('filter(findings, f -> f.rank < 4)')} as binary), 256)").alias("base_sha256"),
        F.expr(text.format("findings")).alias("spans"),
    )


def _oracle() -> str:
    q = lambda p: "'" + p.replace("'", "''") + "'"
    fold = lambda word: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)  # noqa: E731  RE2 would fold other letters too
    assign = ASSIGN.replace("(?i:password|passwd|secret|token|api_?key)", "|".join(map(fold, ("password", "passwd", "secret", "token", "api_?key"))))
    run = "|".join(f"{re_escape(c)}{{6}}" for c in ALPHABET)
    allowed = " or ".join(f"regexp_matches(c, {q(p)})" for p in ALLOWED)
    inside = " or ".join(f"regexp_matches(substr(c, w+1, {WINDOW}), {q(run if p.startswith('(.)') else p)})" for p in ALLOWED_INSIDE)
    most = " ".join(f"when regexp_matches(c, {q(p)}) then {math.floor((math.log2(WINDOW) - h) * WINDOW * 1e6)}" for p, h in CLASSES)
    kinds = " union all ".join(
        f"select doc_id, '{k}' as kind, {r} as rank, string_split_regex(t, {q(p)}) as gaps, regexp_extract_all(t, {q(p)}) as ms, regexp_extract_all(t, {q(p)}, {g}) as gs from d"
        for k, r, p, g in (("assign", 1, assign, 2), ("access", 2, "AKIA[A-Z0-9]+", 0), ("hex", 3, "[0-9a-f]+", 0), ("entropy", 4, CANDIDATE, 0))
    )
    return f"""
with d as (select doc_id, coalesce(text,'') as t from documents), m as ({kinds}),
 p as (select *, unnest(range(1, len(ms)+1)) as i from m),
 s as (select doc_id, kind, rank, ms[i] as c, length(gs[i]) as g, (list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i-1], lambda x: length(x))), 0))::bigint as b from p),
 base as (select doc_id, kind, rank, b, b + length(c) as e from s where (kind = 'assign' and g >= {LEAST}) or (kind = 'access' and g >= 20) or (kind = 'hex' and g >= 24)),
 cand as (select doc_id, b, c, case {most} end as most from s where kind = 'entropy' and not ({allowed})),
 pos as (select *, unnest(range(0, length(c) - {WINDOW} + 1)) as w from cand),
 win as (select * from pos where not ({inside})),
 ch as (select doc_id, b, w, most, unnest(string_split(substr(c, w+1, {WINDOW}), '')) as x from win),
 cnt as (select doc_id, b, w, most, x, count(*) as n from ch group by all),
 hot as (select doc_id, b, w from cnt group by doc_id, b, w, most having sum(round(n*log2(n)*1e6)) <= most),
 ent as (select doc_id, 'entropy' as kind, 4 as rank, b + min(w) as b, b + max(w) + {WINDOW} as e from hot group by doc_id, b),
 f as (select * from base union all select doc_id, kind, rank, b, e from ent),
 j as (select doc_id, count(*) filter (where rank=1) as n_assign, count(*) filter (where rank=2) as n_access, count(*) filter (where rank=3) as n_hex, count(*) filter (where rank=4) as n_entropy,
   string_agg(kind || ':' || b || ':' || e, ',' order by b, rank) filter (where rank < 4) as base, string_agg(kind || ':' || b || ':' || e, ',' order by b, rank) as spans from f group by doc_id)
select d.doc_id, coalesce(n_assign,0) as n_assign, coalesce(n_access,0) as n_access, coalesce(n_hex,0) as n_hex, coalesce(n_entropy,0) as n_entropy, sha256(coalesce(base,'')) as base_sha256, coalesce(spans,'') as spans from d left join j using (doc_id)
"""


def re_escape(c: str) -> str:
    return c if c.isalnum() else f"[{c}]"


OP2_SQL = _oracle()
