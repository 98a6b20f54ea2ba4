"""Secrets in texts, and credentials linked from their parts.

Assignments, access identifiers and long hexadecimal strings are reported wherever they occur. Weaker
parts, account names, mixed strings of letters and digits, and addresses of services, are reported
only where the parts that complete them lie near in the same section: a name with a secret, a mixed
string with an identifier, an address with both.

The parts of all texts are small rows. What is near is an interval join on stretches of a section:
each stretch keeps its first and last part of every role, which decides exactly whether one lies
within reach, and no pairs are listed. A section with very many parts costs no more than its parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from paylake.operators.scratch import stored

# Patterns of the strong kinds. Minimum lengths of hex and access are part of the
# pattern, which finds the same as dropping shorter matches, since a match takes its whole run.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6  # characters of an assignment's value
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

# Patterns of the weak kinds.
USER = r"""(?i:user(?:name)?|login|account|client_id|access_key_id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})"""
MIXED = r"[A-Za-z0-9+/]{32,}={0,2}"
ENDPOINT = r"""(?i:https?|jdbc:[a-z0-9]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|ftp)://[^\x09-\x0D\x20"'<>]+"""
BREAK = r"\n[ \t]*\n"

KINDS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "user": USER, "mixed": MIXED, "endpoint": ENDPOINT, "break": BREAK}
STRONG = ("assign", "access", "hex")
ROLE = {"access": "identifier", "user": "identifier", "assign": "secret", "hex": "secret", "mixed": "secret", "endpoint": "endpoint"}
NEEDS = {"user": ("secret",), "mixed": ("identifier",), "endpoint": ("identifier", "secret")}
REACH = 300  # code points between the beginnings of parts that belong together


def _matches(documents: DataFrame) -> DataFrame:
    """row, doc_id and for each kind the lengths before, of and whether to report every match."""
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = rows.select("*", *(F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(f"m_{k}") for k, p in KINDS.items()))

    def lengths(kind: str, pattern: str) -> Column:
        m = F.col(f"m_{kind}")
        gaps = F.transform(F.split("text", pattern, -1), lambda g: F.length(g))
        if kind == "assign":
            whole = F.transform(F.regexp_extract_all("text", F.lit(pattern), F.lit(2)), lambda v: F.length(v) >= ASSIGN_VALUE)
        elif kind == "mixed":
            whole = F.transform(m, lambda v: v.rlike("[a-z]") & v.rlike("[A-Z]") & v.rlike("[0-9]"))
        else:
            whole = F.transform(m, lambda v: F.lit(True))
        parts = F.arrays_zip(F.slice(gaps, 1, F.size(m)).alias("gap"), F.transform(m, lambda v: F.length(v)).alias("size"), whole.alias("report"))
        return F.when(F.size(m) > 0, parts).alias(kind)

    return found.select("row", "doc_id", *(lengths(k, p) for k, p in KINDS.items()))


def _placed(matches: DataFrame) -> DataFrame:
    """row, kind, start and end of every match, by running sums of lengths within a text."""
    each = None
    for kind in KINDS:
        one = matches.where(F.col(kind).isNotNull()).select("row", F.lit(kind).alias("kind"), F.posexplode(kind).alias("nth", "m")).select(
            "row", "kind", "nth", "m.gap", "m.size", "m.report")
        each = one if each is None else each.union(one)
    until = Window.partitionBy("row", "kind").orderBy("nth")
    end = F.sum(F.col("gap") + F.col("size")).over(until)
    return each.withColumn("end", end).where("report").select("row", "kind", (F.col("end") - F.col("size")).alias("start"), "end")


def link(parts: DataFrame) -> DataFrame:
    """The parts to report: row, kind, start, end, of rows with these columns and those of breaks.

    A weak part that begins inside a strong one is the same secret and is left out.
    """
    order = Window.partitionBy("row").orderBy("start", "kind", "end")
    section = F.sum(F.when(F.col("kind") == "break", 1).otherwise(0)).over(order)
    covered = F.max(F.when(F.col("kind").isin(*STRONG), F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    known = parts.select("*", section.alias("section"), covered.alias("covered")).where("kind <> 'break'")
    strong = F.col("kind").isin(*STRONG)
    known = known.where(strong | F.col("covered").isNull() | (F.col("covered") <= F.col("start")))
    role = F.create_map(*(F.lit(x) for pair in ROLE.items() for x in pair))[F.col("kind")]
    known = stored(known.select("row", "kind", "start", "end", "section", F.floor(F.col("start") / REACH).alias("stretch"), role.alias("role")), "parts")
    span = known.groupBy("row", "section", "stretch", "role").agg(F.min("start").alias("first"), F.max("start").alias("last"))
    around = span.select("row", "section", F.explode(F.array(*(F.col("stretch") + i for i in (-1, 0, 1)))).alias("stretch"), F.col("role").alias("near"), "first", "last")
    weak = known.where(~strong)
    met = weak.join(around, ["row", "section", "stretch"]).where(
        (F.col("near") != F.col("role")) & (F.abs(F.col("first") - F.col("start")) <= REACH) | (F.col("near") != F.col("role")) & (F.abs(F.col("last") - F.col("start")) <= REACH))
    near = met.groupBy("row", "kind", "start", "end").agg(F.collect_set("near").alias("roles"))
    complete = F.lit(False)
    for kind, needs in NEEDS.items():
        complete = complete | ((F.col("kind") == kind) & F.forall(F.array(*map(F.lit, needs)), lambda r: F.array_contains("roles", r)))
    return known.where(strong).select("row", "kind", "start", "end").union(near.where(complete).select("row", "kind", "start", "end"))


def scan(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with row and doc_id, one for each document, and the spans found: row, kind, start, end.

    Positions are code points, the end exclusive. A null or empty text has no spans; repeated rows
    and rows of a null doc_id are scanned each. Other columns are not carried along, and an empty
    table gives empty ones.
    """
    matches = stored(_matches(documents), "matches")
    return matches.select("row", "doc_id"), link(_placed(matches))


def digests(documents: DataFrame) -> DataFrame:
    """doc_id, the number of spans of each strong kind, the digest of these spans, and all spans."""
    rows, spans = scan(documents)
    place = F.create_map(*(F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)))[F.col("kind")]
    one = F.struct("start", place.alias("place"), "end", F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string")).alias("shown"), F.col("kind").isin(*STRONG).alias("strong"))
    by_row = spans.groupBy("row").agg(
        *(F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in STRONG), F.array_sort(F.collect_list(one)).alias("all"))
    joined = rows.join(by_row, "row", "left")
    strong = F.array_join(F.transform(F.filter("all", lambda s: s["strong"]), lambda s: s["shown"]), ",")
    return joined.select(
        "doc_id", *(F.coalesce(f"n_{k}", F.lit(0).cast("bigint")).alias(f"n_{k}") for k in STRONG),
        F.sha2(F.coalesce(strong, F.lit("")), 256).alias("base_sha256"),
        F.coalesce(F.array_join(F.transform("all", lambda s: s["shown"]), ","), F.lit("")).alias("spans"))
