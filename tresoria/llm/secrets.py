"""Secret scan (DataFrame functions only).

Three fixed patterns give the base spans.  Beside them, candidate strings (runs
of key characters that hold a digit or change their case several times, without the words
of a path or slug that they begin with) are scanned with a sliding window: the
Shannon entropy of each window is kept by incremental counts, where a step
changes the counts of the leaving and the entering character only, and is held
against the limit of the candidate's character class.  An allow list suppresses
what looks random but is no secret.

Defined results: a null text counts as empty and gives no span; a null id stays
null; repeated rows are scanned alike; positions are code points; a very long text is
scanned whole in its row; an empty table gives no row; extra columns are ignored.  One
projection of the scan: no shuffle and nothing gathered per key.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tresoria.llm.common import SPAN, labelled, matches, settled, span_list, text_or_empty

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Whole runs only, so a minimal length inside the pattern drops what the base rule drops.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")

#: Runs of key characters with a digit, or with three steps from a small to a capital letter; the look-behind starts at
#: a run's first character.
CANDIDATE = (r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9]|(?:[A-Za-z+/_-]*?[a-z][A-Z]){3})"
             r"[A-Za-z0-9+/_-]{20,}+={0,2}")
#: Words that a run begins with, each up to a separator, as in ``webhooks/incoming/``: no part of the candidate.
LEAD = r"^[/_-]*(?:[a-z]{2,15}[/_-])+"
LEAST = 20

#: Character classes, first fit wins: pattern of the whole candidate, window, least entropy in bits.
CLASSES = (
    ("digit", r"^[0-9]+$", 20, 99.0),
    ("hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 16, 2.7),
    ("one_case", r"^(?:[a-z0-9]+|[A-Z0-9]+)$", 20, 3.3),
    ("letters", r"^[A-Za-z+/_-]+$", 20, 3.95),
    ("mixed", r"", 20, 3.5),
)
#: Random-looking strings that are no secrets: UUIDs, samples, dated or slugged names, paths.
ALLOW = (r"(?i)(?:example|sample|dummy|placeholder|changeme|x{6}|0123456789|123456789|abcdef0123|abcdefgh)"
         r"|^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
         r"|^(?:[a-z]+[-_/])+[a-z]*[0-9]{1,4}$"
         r"|^[0-9]{4}-[0-9]{2}-[0-9]{2}[A-Za-z0-9_-]*$"
         r"|^(?:[a-z]{2,15}[0-9]{0,4}[/_-])*[a-z]{2,15}[0-9]{0,4}$"
         r"|(?:[a-z]{3,}[/_-]){3}")

_MAX_WINDOW = max(w for _, _, w, _ in CLASSES)
#: c * log2(c): the part of a character seen c times in a window's entropy.
_PART = [0.0] + [c * math.log2(c) for c in range(1, _MAX_WINDOW + 1)]


def base_spans(text: Column) -> dict[str, Column]:
    """The spans of the three fixed patterns."""
    assign = F.filter(matches(text, ASSIGN), lambda x: F.length(
        F.regexp_extract(x["t"], ASSIGN, 2)) >= 12)
    return {"assign": assign,
            "access": matches(text, ACCESS, text.contains("AKIA")),
            "hex": matches(text, HEX)}


def _hot_part(cand: Column, window: int, bits: float) -> Column:
    """(start, end) in the candidate of the stretch covered by windows of ``bits`` or more."""
    part = F.array(*[F.lit(x) for x in _PART])
    size = F.lit(window)

    def step(acc, ch):
        i, win = acc["i"] + 1, acc["win"]
        # a full window loses its first character
        full = F.length(win) == size
        out = F.substring(win, 1, 1)
        held = F.length(win) - F.length(F.replace(win, out, F.lit("")))
        sum_out = F.when(full, acc["sum"] - F.get(part, held) + F.get(part, held - 1)).otherwise(acc["sum"])
        rest = F.when(full, F.substring(win, 2, window)).otherwise(win)
        before = F.length(rest) - F.length(F.replace(rest, ch, F.lit("")))
        total = sum_out - F.get(part, before) + F.get(part, before + 1)
        now = F.concat(rest, ch)
        # entropy = log2(window) - sum / window, so a small sum is a high entropy
        hot = (F.length(now) == size) & (F.lit(math.log2(window)) - total / F.lit(float(window)) >= F.lit(bits))
        return F.struct(i.alias("i"), now.alias("win"), total.alias("sum"),
                        F.when(hot & (acc["s"] < 0), i - size).otherwise(acc["s"]).alias("s"),
                        F.when(hot, i).otherwise(acc["e"]).alias("e"))

    start = F.struct(F.lit(0).alias("i"), F.lit("").alias("win"), F.lit(0.0).alias("sum"),
                     F.lit(-1).alias("s"), F.lit(-1).alias("e"))
    return F.aggregate(F.array_remove(F.split(cand, ""), ""), start, step,
                       lambda acc: F.struct(acc["s"].alias("s"), acc["e"].alias("e")))


def entropy_spans(text: Column) -> Column:
    """Stretches of candidates whose windows are random enough and not on the allow list."""
    def judged(c):
        found = None
        for _, whole, window, bits in reversed(CLASSES):
            part = _hot_part(c["t"], window, bits)
            found = part if found is None else F.when(c["t"].rlike(whole), part).otherwise(found)
        return F.struct(c["s"].alias("s"), c["t"].alias("t"), found.alias("p"))

    rest = lambda c: F.regexp_replace(c["t"], LEAD, "")
    cut = F.transform(matches(text, CANDIDATE), lambda c: F.struct(
        (c["e"] - F.length(rest(c))).alias("s"), c["e"].alias("e"), rest(c).alias("t")))
    open_ = F.filter(cut, lambda c: (F.length(c["t"]) >= LEAST) & ~c["t"].rlike(ALLOW))
    hot = F.filter(F.transform(open_, judged), lambda x: x["p"]["s"] >= 0)
    return F.transform(hot, lambda x: F.struct(
        (x["s"] + x["p"]["s"]).alias("s"), (x["s"] + x["p"]["e"]).alias("e"),
        F.substring(x["t"], 1, 0).alias("t"))).cast(SPAN)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``base`` and ``found`` spans
    (``array<struct<s,k,e,kind,t>>``, by start then kind).  ``found`` holds the
    base spans and those entropy spans that no base span contains."""
    text = F.col("__t")
    df = docs.select(F.col(id_col).alias("__id"), text_or_empty(text_col).alias("__t"))
    parts = [labelled(spans, kind, KINDS.index(kind)) for kind, spans in base_spans(text).items()]
    df = df.withColumn("__base", F.array_sort(F.concat(*parts)))
    df = df.withColumn("__more", F.filter(entropy_spans(text), lambda x: ~F.exists(
        "__base", lambda b: (b["s"] <= x["s"]) & (b["e"] >= x["e"]))))
    more = labelled(F.col("__more"), "entropy", KINDS.index("entropy"))
    return settled(df.withColumnRenamed("__id", id_col), [id_col], {
        "base": F.col("__base"), "found": F.array_sort(F.concat("__base", more))})


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, digest of the base spans and list of all spans."""
    n = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(id_col, n("assign"), n("access"), n("hex"),
                        F.sha2(span_list(F.col("base")), 256).alias("base_sha256"),
                        span_list(F.col("found")).alias("spans"))
