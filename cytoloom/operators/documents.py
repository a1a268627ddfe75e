"""Checks of a folder of Markdown documents, as joins and aggregates over their lines (path, n, line)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Months of dates in words, and dates in numbers.
MONTH = r"(?:January|February|March|April|May|June|July|August|September|October|November|December)"
DATE = rf"\b(?:\d{{4}}-\d{{2}}-\d{{2}}|\d{{1,2}}[./]\d{{1,2}}[./]\d{{4}}|\d{{1,2}} {MONTH} \d{{4}}|{MONTH} \d{{1,2}}, \d{{4}})\b"
HEADINGS, LAST, WORDS = ("Context", "Options", "Decision", "Consequences"), "**Building block:**", 700


def rows(lines: DataFrame) -> DataFrame:
    """(path, n, c): cells of table rows, trimmed; rows of dashes go."""
    inner = F.regexp_replace(F.trim("line"), r"^\||\|$", "")
    table = lines.where(F.trim("line").startswith("|") & ~F.trim("line").rlike(r"^\|[\s:|-]+\|$"))
    return table.select("path", "n", F.transform(F.split(inner, r"\|"), lambda c: F.regexp_replace(F.trim(c), r"^[`* ]+|[`* ]+$", "")).alias("c"))


def within(lines: DataFrame, heading: str) -> DataFrame:
    """Lines of the first section of each document whose heading begins so (case ignored), without those of the next at its level or above."""
    level = F.length(F.regexp_extract("line", r"^(#+)\s", 1))
    title = F.lower(F.regexp_replace("line", r"^#+\s+", ""))
    marked = lines.withColumns({"__l": F.when(level > 0, level), "__t": (level > 0) & F.startswith(title, F.lit(heading.lower()))})
    first = marked.where("__t").groupBy("path").agg(F.min(F.struct("n", "__l")).alias("f")).select("path", F.col("f.n").alias("__from"), F.col("f.__l").alias("__at"))
    inside = marked.join(first, "path").where(F.col("n") > F.col("__from"))
    end = inside.where(F.col("__l") <= F.col("__at")).groupBy("path").agg(F.min("n").alias("__to"))
    return inside.join(end, "path", "left").where(F.col("n") < F.coalesce("__to", F.lit(2**62))).select(*lines.columns)


def missing(wanted: DataFrame, present: DataFrame) -> DataFrame:
    """Patterns of (pattern), as regular expressions of whole paths, that no (path) matches."""
    return wanted.join(present, F.expr("path rlike concat('^(?:', pattern, ')$')"), "left_anti")  # a list of some dozens


def requirements(lines: DataFrame, pattern: str = r"(?:US|FR|NFR)-[A-Z]?\d+", priorities: str = "M|S|C|W", tag: str = r"\[([A-Z0-9]+)\]") -> DataFrame:
    """(path, id, priority, tags) of the first table row of each id in a document; priority is null and tags are empty if there are none."""
    r = rows(lines).where(F.col("c")[0].rlike(f"^{pattern}$"))
    first = r.groupBy("path", F.col("c")[0].alias("id")).agg(F.min(F.struct("n", "c")).alias("f"))
    rest = F.slice("f.c", 2, 2**30)
    found = F.filter(rest, lambda c: c.rlike(f"^(?:{priorities})$"))
    return first.select("path", "id", F.when(F.size(found) > 0, found[0]).alias("priority"), F.array_sort(F.array_distinct(F.regexp_extract_all(F.array_join(rest, " "), F.lit(tag), F.lit(1)))).alias("tags"))


def uncovered(source: DataFrame, target: DataFrame, excused: DataFrame) -> DataFrame:
    """(id, why) of requirements of source that target lacks or changes; excused: lines in which an id is named where that is agreed."""
    t = target.select("id", F.col("priority").alias("p2"), F.col("tags").alias("t2"), F.lit(True).alias("here"))
    named = _ids(excused).withColumn("named", F.lit(True))
    j = source.join(t, "id", "left").join(named, "id", "left")
    agreed = F.coalesce("named", F.lit(False))
    why = (
        F.when(F.col("here").isNull(), "absent").when(F.col("p2").isNull(), "no priority").when((F.col("priority") != F.col("p2")) & ~agreed, "another priority")
        .when(F.size("t2") == 0, "no source").when((F.col("tags") != F.col("t2")) & ~agreed, "another source")
    )
    return j.select("id", why.alias("why")).where("why is not null")


def _ids(lines: DataFrame, pattern: str = r"\b((?:US|FR|NFR)-[A-Z]?\d+)\b") -> DataFrame:
    return lines.select(F.explode(F.regexp_extract_all("line", F.lit(pattern), F.lit(1))).alias("id")).distinct()


def without_criteria(requirements_: DataFrame, lines: DataFrame, priorities: tuple[str, ...] = ("M", "S")) -> DataFrame:
    """Ids of requirements of these priorities without a line AC-<id>.<n> that says given, when and then."""
    says = F.lit(True)
    for word in ("given", "when", "then"):
        says = says & F.col("line").rlike(rf"(?i)\b{word}\b")
    met = lines.where(says).select(F.explode(F.regexp_extract_all("line", F.lit(r"\bAC-((?:US|FR|NFR)-[A-Z]?\d+)\.\d+\b"), F.lit(1))).alias("id")).distinct()
    return requirements_.where(F.col("priority").isin(*priorities)).select("id").join(met, "id", "left_anti")


def untested(requirements_: DataFrame, lines: DataFrame, test: str = r"T-[A-Z0-9]+(?:-[A-Z0-9]+)+") -> DataFrame:
    """(id, why): requirements that the matrix of a test plan gives no test, or one that its catalogue doesn't have."""
    r = rows(lines)
    known = r.where(F.col("c")[0].rlike(f"^{test}$")).select(F.col("c")[0].alias("test")).distinct()
    given = r.where(F.col("c")[0].rlike(r"^(?:US|FR|NFR)-[A-Z]?\d+$")).select(F.col("c")[0].alias("id"), F.explode(F.regexp_extract_all(F.array_join(F.slice("c", 2, 2**30), " "), F.lit(f"({test})"), F.lit(1))).alias("test")).distinct()
    none = requirements_.select("id").distinct().join(given, "id", "left_anti").select("id", F.lit("no test").alias("why"))
    return none.unionByName(given.join(known, "test", "left_anti").join(requirements_.select("id").distinct(), "id", "left_semi").select("id", F.concat(F.lit("unknown "), "test").alias("why")))


def dates(lines: DataFrame, allowed: str | None = None) -> DataFrame:
    """(path, n, date): calendar dates in the lines, but those that match `allowed`."""
    text: Column = F.regexp_replace("line", allowed, " ") if allowed else F.col("line")
    return lines.select("path", "n", F.explode(F.regexp_extract_all(text, F.lit(f"({DATE})"), F.lit(1))).alias("date"))


def open_questions(lines: DataFrame, columns: tuple[str, ...] = ("recipient", "blocks", "status", "default")) -> DataFrame:
    """(id, why): questions Q1, Q2, ... of a table with an ID header whose named columns are missing or empty, and unanswered ones that no other line names."""
    r = rows(lines)
    header = r.where(F.lower(F.col("c")[0]) == "id").groupBy("path").agg(F.min_by("c", "n").alias("h"))
    q = r.where(F.col("c")[0].rlike(r"^Q\d+$")).join(header, "path", "left")
    place = lambda name: F.coalesce(F.array_position(F.transform("h", lambda c: F.lower(c).contains(name)), F.lit(True)), F.lit(0))
    value = lambda name: F.regexp_replace(F.coalesce(F.try_element_at("c", F.when(place(name) > 0, place(name)).cast("int")), F.lit("")), "^[—\\- ]+$", "")
    empty = q.select(F.col("c")[0].alias("id"), F.explode(F.array(*[F.when(value(c) == "", F.concat(F.lit("no "), F.lit(c))) for c in columns])).alias("why")).where("why is not null")
    named = lines.where(~F.trim("line").startswith("|")).select(F.explode(F.regexp_extract_all("line", F.lit(r"\b(Q\d+)\b"), F.lit(1))).alias("id")).distinct()
    lost = q.where(~F.startswith(F.lower(value("status")), F.lit("answered"))).select(F.col("c")[0].alias("id")).join(named, "id", "left_anti").select("id", F.lit("on no agenda").alias("why"))
    return empty.unionByName(lost)


def decision_records(lines: DataFrame, headings: tuple[str, ...] = HEADINGS, last: str = LAST, words: int = WORDS) -> DataFrame:
    """(path, why): records without one of the headings, of too many words, or whose last line begins otherwise."""
    has = [F.coalesce(F.bool_or(F.col("line").rlike(rf"^##\s+{h}")), F.lit(False)).alias(h) for h in headings]
    n = F.sum(F.size(F.filter(F.split(F.trim("line"), r"\s+"), lambda w: w != ""))).alias("words")
    g = lines.groupBy("path").agg(*has, n, F.max_by(F.when(F.trim("line") != "", F.col("line")), F.when(F.trim("line") != "", F.col("n"))).alias("end"))
    why = [F.when(~F.col(h), F.lit(f"no {h}")) for h in headings] + [F.when(F.col("words") > words, "too long"), F.when(~F.startswith(F.coalesce("end", F.lit("")), F.lit(last)), "another last line")]
    return g.select("path", F.explode(F.array(*why)).alias("why")).where("why is not null")


def phases(lines: DataFrame) -> DataFrame:
    """(path, n, phase): headings 'Phase <n>' that come after one of a higher number."""
    p = lines.withColumn("phase", F.regexp_extract("line", r"^#+\s+Phase\s+(\d+)", 1)).where("phase <> ''").withColumn("phase", F.col("phase").cast("int"))
    before = F.max("phase").over(Window.partitionBy("path").orderBy("n").rowsBetween(Window.unboundedPreceding, -1))  # a document's headings
    return p.withColumn("b", before).where("b > phase").select("path", "n", "phase")
