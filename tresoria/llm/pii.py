"""Personal data by boosted candidate classification (DataFrame functions only).

Exact rules give the base spans (mail, address, card and phone numbers).  Beside
them, high-recall generators propose overlapping spans of loose forms, and a
proposal may fit several kinds.  It is described by a few format and context
features with a handful of values each, so all proposals of the corpus fall into a
table of bounded size (:data:`LATTICE` cells at most) that one grouped count fills.

Boosted trees are fitted on that table.  A proposal that an exact rule takes from
end to end is a hit of the rule's kind and a miss of the others; any other proposal
is a miss unless words before it speak of the kind: then it is what the model has to
decide and takes no part in the fit.  What makes a rule accept a proposal (the plus
of a phone number, the dots of an address, the length of a card number) is no
feature, or the trees could only repeat the rules.  A kind has one ensemble for
proposals with its own context and one for the others; each starts from its hit rate
with ``prior`` proposals of :data:`BELIEF` added, so a kind without a single hit has
a model too.  The sums of the leaves of every cell are one constant array, so scoring
is a lookup in Spark.  Thresholds
are calibrated on the same counts: the lowest score, at least even odds, down to
which proposals are hits at ``precision`` or better.

Defined results: a null text counts as empty and gives no span; a null id stays
null; repeated rows are scanned alike; an empty table gives no row, extra columns
are not read, whatever their names.  Overlaps: base spans always stay and a proposal
that meets one goes; of the others the better score stays, an earlier start at a tie.
That is one pass over the sorted spans of a text, so its time grows with the text.
The only shuffle is the grouped count, a few hundred rows a task.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tresoria.llm.common import labelled, matches, settled, span_list, text_or_empty

KINDS = ("email", "ip", "card", "phone")

# Possessive repeats: nothing that follows could use a shorter repeat, and a
# repeat of any length needs no stack.  ``\G`` or the look-behind: inside one run
# every later start has the same continuation as the run's first character.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
IP_FITS = rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$"

#: Generators of loose forms.
LOOSE = {
    "email": r"(?i)[a-z0-9_%+-][a-z0-9._%+-]{0,63}\x20?(?:@|\(at\)|\[at\])\x20?[a-z0-9-]{1,63}(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[a-z0-9-]{2,63}){1,4}",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\x20?(?:\.|\[\.\]|\(\.\)|\[dot\]|\(dot\))\x20?[0-9]{1,3}){3}(?![0-9])",
    "number": r"[+(]?(?<![0-9])[0-9](?:[\x20().,/-]{0,2}[0-9]){6,23}(?![0-9])",
}
DATE = r"^(?:(?:19|20)[0-9]{2}[./-][0-9]{1,2}[./-][0-9]{1,2}|[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2})(?![0-9])"

DIGITS_CUT = (8, 10, 13, 16, 20)
#: Context words by kind; the last one in the characters before a proposal counts.
CONTEXT = {
    "email": r"\b(?:(?:e-?)?mails?|contact|write to|mailto|kontakt|correo|courriel)\b",
    "ip": r"\b(?:ip|ipv4|hosts?|server|addr|address|ping|login from)\b",
    "card": r"\b(?:cards?|visa|mastercard|amex|credit|payment|kreditkarte|karte|tarjeta|carte)\b",
    "phone": r"\b(?:telephone|phone|tel|call|mobile|cell|fax|telefon|t[eé]l[eé]fono|t[eé]l[eé]phone|whatsapp)\b",
}
OTHER_CONTEXT = r"(?:\b(?:id|order|invoice|isbn|no|ref|version|page|total|price)\b|[$€])"
NEAR = 40
#: name: number of values
FEATURES = {"digits": 6, "groups": 4, "sep": 5, "edge": 3, "context": 6}
LATTICE = math.prod(FEATURES.values())
#: Features that would tell a kind's hits by its own rule, hidden from its trees.
HIDDEN = {"email": (), "ip": ("sep",), "card": ("digits", "sep"), "phone": ()}
#: Share of hits among proposals with and without the kind's context, before any count.
BELIEF = {"own": 0.99, "rest": 0.02}


def _digits(t: Column) -> Column:
    return F.regexp_replace(t, "[^0-9]", "")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def luhn(digits: Column) -> Column:
    """True when the check digit of a string of digits fits."""
    parts = F.transform(F.array_remove(F.split(F.reverse(digits), ""), ""), lambda d, i: F.when(
        i % 2 == 0, d.cast("int")).otherwise(F.get(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), d.cast("int"))))
    return F.aggregate(parts, F.lit(0), lambda a, x: a + x) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """The spans of the exact rules; a failing match is dropped, its text is used up."""
    n = lambda x: F.length(_digits(x["t"]))
    return {
        "email": matches(text, EMAIL, text.contains("@")),
        "ip": F.filter(matches(text, IP), lambda x: x["t"].rlike(IP_FITS)),
        "card": F.filter(matches(text, CARD), lambda x: n(x).between(16, 19) & luhn(_digits(x["t"]))),
        "phone": F.filter(matches(text, PHONE, text.contains("+")), lambda x: n(x).between(8, 15)),
    }


def _context(before: Column) -> Column:
    """The kind (from 1) whose word comes last before a proposal, in its sentence; 5 for
    words of other numbers, 0 without any."""
    near = F.regexp_replace(before, r"(?s)^.*[.!?]\s+(?=\p{Lu})", "")
    last = F.lower(F.regexp_extract(near, rf"(?is)^.*({'|'.join((*CONTEXT.values(), OTHER_CONTEXT))})", 1))

    def kind_of(word):
        found = F.when(word == "", 0)
        for i, kind in enumerate(KINDS):
            found = found.when(word.rlike(f"^{CONTEXT[kind]}$"), i + 1)
        return found.otherwise(5)

    return _let(last, kind_of)


def _features(x: Column) -> Column:
    """The feature values of a proposal, each a small integer."""
    t = x["t"]
    band = _let(F.length(_digits(t)), lambda n: sum(((n >= cut).cast("int") for cut in DIGITS_CUT), F.lit(0)))
    sep = (F.when(~t.rlike(r"[^0-9+]"), 0).when(~t.rlike(r"[^0-9+\x20]"), 1).when(~t.rlike(r"[^0-9+-]"), 2)
           .when(~t.rlike(r"[^0-9+.]"), 3).otherwise(4))
    values = {
        "digits": band,
        "groups": F.least(F.size(F.array_remove(F.split(t, "[^0-9]+"), "")), F.lit(4)) - 1,
        "sep": sep,
        "edge": F.when(x["b"].rlike(r"[\p{L}0-9_]$"), 1).when(x["b"].rlike(r"[=/#%&$€@.-]$"), 2).otherwise(0),
        "context": F.when(x["b"] == "", 0).otherwise(_context(x["b"])),
    }
    return F.struct(*[F.greatest(v.cast("int"), F.lit(0)).alias(k) for k, v in values.items()])


def _fits(t: Column, form: str) -> dict[str, Column]:
    """The kinds that a proposal of a form can be at all."""
    digits = _digits(t)
    n = F.length(digits)
    if form == "email":
        return {"email": F.lit(True)}
    if form == "ip":
        return {"ip": F.regexp_replace(t, "[^0-9]+", ".").rlike(IP_FITS)}
    return {"card": n.between(13, 19) & ~t.startswith("+") & luhn(digits),
            "phone": n.between(7, 15) & ~t.contains(",") & ~t.rlike(DATE)}


def _exact(t: Column) -> dict[str, Column]:
    """Whether a kind's exact rule takes a proposal that fits the kind from end to end."""
    n = F.length(_digits(t))
    return {"email": t.rlike(f"^(?:{EMAIL})$"), "ip": t.rlike(IP_FITS),
            "card": (n >= 16) & t.rlike(r"^[0-9](?:[\x20-]?[0-9])+$"),
            "phone": (n >= 8) & t.rlike(f"^{PHONE}$")}


def _found(text: Column, pattern: str, there: Column) -> Column:
    """Matches as in :func:`common.matches` with ``b``, up to :data:`NEAR` characters
    before each: taken from the piece between two matches, never from the whole text."""
    zipped = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), lambda p: F.struct(
            F.length(p).alias("n"), F.substring(p, -NEAR, NEAR).alias("b"))).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))

    def step(acc, z):
        start = acc["pos"] + z["gap"]["n"]
        end = start + F.length(z["hit"])
        before = F.substring(F.concat(acc["last"], z["gap"]["b"]), -NEAR, NEAR)
        one = F.struct(start.alias("s"), end.alias("e"), z["hit"].alias("t"), before.alias("b"))
        return F.struct(F.coalesce(end, start).alias("pos"), F.coalesce(z["hit"], F.lit("")).alias("last"),
                        F.when(z["hit"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(one))).alias("out"))

    none = F.array().cast("array<struct<s:int,e:int,t:string,b:string>>")
    found = F.aggregate(zipped, F.struct(F.lit(0).alias("pos"), F.lit("").alias("last"), none.alias("out")), step,
                        lambda acc: acc["out"])
    return F.when(there & text.rlike(pattern), found).otherwise(none)


def proposals(text: Column, exact: bool = False) -> Column:
    """Loose spans with their features and, in the order of :data:`KINDS`, the kinds they
    ``fit``; with ``exact`` also ``hit``, the kind whose rule takes them, or -1."""
    def seen(form):
        def one(x):
            fits = _fits(x["t"], form)
            fit = F.array(*[fits.get(k, F.lit(False)) for k in KINDS])
            columns = [x["s"].alias("s"), x["e"].alias("e"), _features(x).alias("f"), fit.alias("fit")]
            if exact:
                rule = _exact(x["t"])
                hit = F.lit(-1)
                for i, kind in reversed(list(enumerate(KINDS))):
                    if kind in fits:
                        hit = F.when(fits[kind] & rule[kind], i).otherwise(hit)
                columns.append(hit.alias("hit"))
            return F.struct(*columns)
        return one

    there = {"email": text.rlike(r"@|\((?i:at)\)|\[(?i:at)\]"), "ip": F.lit(True), "number": F.lit(True)}
    return F.concat(*[F.transform(_found(text, p, there[form]), seen(form)) for form, p in LOOSE.items()])


@dataclass
class Side:
    """Boosted trees of depth two: (feature, value) tests and four leaves each."""

    bias: float
    threshold: float = 0.0
    trees: list = field(default_factory=list)

    def score_cell(self, cell: tuple) -> float:
        s = self.bias
        for (f, v), (left, right) in self.trees:
            g, w, lo, hi = right if cell[f] == v else left
            s += hi if cell[g] == w else lo
        return s


@dataclass
class Ensemble:
    """The trees of a kind for proposals with its own context and for the rest."""

    kind: str
    own: Side
    rest: Side

    def _side(self, cell: tuple) -> Side:
        return self.own if cell[-1] == KINDS.index(self.kind) + 1 else self.rest

    def score_cell(self, cell: tuple) -> float:
        return self._side(cell).score_cell(cell)

    def takes(self, cell: tuple) -> bool:
        return self.score_cell(cell) >= self._side(cell).threshold

    def score(self, f: Column) -> Column:
        """The log-odds of a proposal, null below the threshold: the trees' sums of all
        :data:`LATTICE` cells as one constant array, looked up by the cell's place."""
        sums = (repr(self.score_cell(c)) if self.takes(c) else "-Infinity"
                for c in itertools.product(*map(range, FEATURES.values())))
        place = F.lit(0)
        for name, size in FEATURES.items():
            place = place * size + f[name]
        return F.nullif(F.get(F.split(F.lit(",".join(sums)), ",").cast("array<double>"), place), F.lit(-math.inf))


def _newton(rows, l2):
    """Step and gain of one leaf over rows of (hits, all, probability)."""
    g = sum(h - n * p for h, n, p in rows)
    w = sum(n * p * (1 - p) for h, n, p in rows) + l2
    return g / w, g * g / w


def _boosted(rows: list[tuple], tests: list[tuple], belief: float, rounds: int, rate: float, l2: float,
             precision: float, prior: float) -> Side:
    """Trees and threshold from rows of (features, hits, all)."""
    hits, total = sum(r[1] for r in rows) + prior * belief, sum(r[2] for r in rows) + prior
    side = Side(math.log(hits / (total - hits)))
    score = {r[0]: side.bias for r in rows}

    def split(part):
        best = None
        for f, v in tests:
            yes = [r[1:] for r in part if r[0][f] == v]
            no = [r[1:] for r in part if r[0][f] != v]
            (hi, a), (lo, b) = _newton(yes, l2), _newton(no, l2)
            if best is None or a + b > best[0] + 1e-12:
                best = (a + b, f, v, lo, hi)
        return best

    for _ in range(rounds if rows else 0):
        now = [(f, h, n, 1 / (1 + math.exp(-score[f]))) for f, h, n in rows]
        gain, f, v, _, _ = split(now)
        if gain < 1e-9:
            break
        leaves = []
        for part in ([r for r in now if r[0][f] != v], [r for r in now if r[0][f] == v]):
            _, g, w, lo, hi = split(part)
            leaves.append((g, w, round(rate * lo, 9), round(rate * hi, 9)))
        side.trees.append(((f, v), tuple(leaves)))
        score = {c: side.score_cell(c) for c in score}
    # whole groups of equal score: scores of expressions and cells add in the same order
    good = seen = 0
    last = math.inf
    for s in sorted({s for s in score.values() if s >= 0}, reverse=True):
        h, n = (sum(r[i] for r in rows if score[r[0]] == s) for i in (1, 2))
        good, seen = good + h, seen + n
        if good < precision * seen or 2 * h < n:
            side.threshold = last
            break
        last = s - 1e-9
    return side


def fit(cells: list[tuple], rounds: int = 12, rate: float = 0.4, l2: float = 4.0, precision: float = 0.95,
        prior: float = 20.0) -> list[Ensemble]:
    """One ensemble a kind from the table of (features, and for each kind the
    proposals that fit it, its hits, and the hits of others among them).

    The table has at most :data:`LATTICE` rows whatever the corpus holds.  ``prior`` is
    the number of proposals that the belief before any count is worth.
    """
    out = []
    for k, kind in enumerate(KINDS):
        tests = [(i, v) for i, (name, size) in enumerate(FEATURES.items()) if name not in HIDDEN[kind] for v in range(size)]
        own, rest = [], []
        for f, fits, hits, others in cells:
            if f[-1] == k + 1:
                own.append((f, hits[k], hits[k] + others[k]))
            else:
                rest.append((f, hits[k], fits[k]))
        limits = (rounds, rate, l2, precision, prior)
        out.append(Ensemble(kind, *[_boosted([r for r in rows if r[2]], tests, BELIEF[side], *limits)
                                    for side, rows in (("own", own), ("rest", rest))]))
    return out


def _prepared(docs: DataFrame, keep: list[Column], text_col: str) -> DataFrame:
    """``keep``, the text as ``__t`` and the base spans as ``__base``, by kind then start."""
    text = F.col("__t")
    df = docs.select(*keep, text_or_empty(text_col).alias("__t"))
    parts = [labelled(spans, kind, KINDS.index(kind)) for kind, spans in base_spans(text).items()]
    return df.withColumn("__base", F.concat(*parts))


def train(docs: DataFrame, text_col: str = "text", **limits) -> list[Ensemble]:
    """Fit the ensembles on the counts of all proposals of all documents."""
    one = docs.select(F.explode(proposals(text_or_empty(text_col), exact=True)).alias("x"))
    x = F.col("x")
    counted = lambda test: [F.count(F.when(x["fit"][k] & test(k), 1)) for k in range(len(KINDS))]
    counts = one.groupBy(*[x["f"][f].alias(f) for f in FEATURES]).agg(
        F.array(*counted(lambda k: F.lit(True))).alias("fits"), F.array(*counted(lambda k: x["hit"] == k)).alias("hits"),
        F.array(*counted(lambda k: (x["hit"] >= 0) & (x["hit"] != k))).alias("others"))
    cells = [(tuple(r[f] for f in FEATURES), r["fits"], r["hits"], r["others"]) for r in counts.collect()]
    return fit(sorted(cells), **limits)


def _apart(base: Column, more: Column) -> Column:
    """The proposals of ``more`` (s, e, k, score) that no span of ``base`` meets, and of
    those that meet each other, in the order of their starts, the better ones."""
    entry = lambda r, x, k, score: F.struct(
        x["s"].alias("s"), F.lit(r).alias("r"), (-x["e"]).alias("back"), x["e"].alias("e"), k.alias("k"), score.alias("score"))
    sorted_ = F.array_sort(F.concat(
        F.transform(base, lambda b: entry(0, b, F.lit(-1), F.lit(0.0))),
        F.transform(more, lambda x: entry(1, x, x["k"], x["score"]))))
    kind = "struct<s:int,r:int,back:int,e:int,k:int,score:double>"
    none = F.array().cast(f"array<{kind}>")
    never = 2**31 - 1

    def unmet_later(acc, x):
        is_base = x["r"] == 0
        return F.struct(F.when(is_base, x["s"]).otherwise(acc["next"]).alias("next"),
                        F.when(is_base | (x["e"] <= acc["next"]), F.concat(acc["out"], F.array(x))).otherwise(acc["out"]).alias("out"))

    left = F.reverse(F.aggregate(F.reverse(sorted_), F.struct(F.lit(never).alias("next"), none.alias("out")), unmet_later,
                                 lambda acc: acc["out"]))

    def better(acc, x):
        is_base, now = x["r"] == 0, acc["now"]
        skip = is_base | (x["s"] < acc["edge"])
        done = ~skip & now.isNotNull() & (x["s"] >= now["e"])
        take = ~skip & (now.isNull() | (x["s"] >= now["e"]) | (x["score"] > now["score"]))
        return F.struct(F.when(is_base, F.greatest(acc["edge"], x["e"])).otherwise(acc["edge"]).alias("edge"),
                        F.when(take, x).otherwise(now).alias("now"),
                        F.when(done, F.concat(acc["out"], F.array(now))).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("edge"), F.lit(None).cast(kind).alias("now"), none.alias("out"))
    return F.aggregate(left, start, better, lambda acc: F.when(acc["now"].isNull(), acc["out"]).otherwise(
        F.concat(acc["out"], F.array(acc["now"]))))


def _selected(df: DataFrame, models: list[Ensemble]) -> DataFrame:
    """``df`` with ``__more``: the proposals that the models take and that stay apart
    from base spans and better proposals."""
    def scored(x):
        odds = F.array_max(F.array(*[F.struct(
            F.when(F.get(x["fit"], F.lit(KINDS.index(m.kind))), m.score(x["f"])).alias("score"),
            F.lit(-KINDS.index(m.kind)).alias("back")) for m in models]))
        return _let(odds, lambda best: F.struct(
            x["s"].alias("s"), x["e"].alias("e"), (-best["back"]).alias("k"), best["score"].alias("score")))

    df = df.withColumn("__open", F.filter(F.transform(proposals(F.col("__t")), scored), lambda x: x["score"].isNotNull()))
    names = F.array(*map(F.lit, KINDS))
    span = "array<struct<s:int,k:int,e:int,kind:string,t:string>>"
    more = F.transform(_apart(F.col("__base"), F.col("__open")), lambda x: F.struct(
        x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), F.get(names, x["k"]).alias("kind"), F.lit("").alias("t")))
    return df.withColumn("__more", F.when(F.size("__open") > 0, more.cast(span)).otherwise(F.array().cast(span)))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", models: list[Ensemble] | None = None) -> DataFrame:
    """One row per row of ``docs``: id, ``base`` and ``found`` spans, by kind then
    start.  Without ``models`` they are fitted on ``docs`` first."""
    models = train(docs, text_col) if models is None else models
    df = _selected(_prepared(docs, [F.col(id_col).alias("__id")], text_col), models)
    of = lambda spans, k: F.filter(spans, lambda x: x["k"] == k)
    found = F.concat(*[F.array_sort(F.concat(of("__base", k), of("__more", k))) for k in range(len(KINDS))])
    return settled(df.withColumnRenamed("__id", id_col), [id_col], {"base": F.col("__base"), "found": found})


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, digest of the base spans and list of all spans."""
    n = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(id_col, *[n(k) for k in KINDS], F.sha2(span_list(F.col("base")), 256).alias("base_sha256"),
                        span_list(F.col("found")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", models: list[Ensemble] | None = None) -> DataFrame:
    """``docs`` with every found span replaced by its kind in brackets, ``[EMAIL]``.

    Overlapping spans become one replacement, named after the first.  A text
    without a span (null included) and all other columns stay as they are.
    """
    models = train(docs, text_col) if models is None else models
    df = _prepared(docs, [F.struct("*").alias("__row")], text_col)
    df = _selected(df, models)
    spans = F.array_sort(F.concat("__base", "__more"))  # by start
    text = F.col("__t")

    def step(acc, x):
        label = F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]"))
        gap = F.substring(text, acc["pos"] + 1, x["s"] - acc["pos"])
        fresh = x["s"] >= acc["pos"]
        return F.struct(F.greatest(acc["pos"], x["e"]).alias("pos"),
                        F.when(fresh, F.concat(acc["out"], gap, label)).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(spans, F.struct(F.lit(0).alias("pos"), F.lit("").alias("out")), step,
                       lambda acc: F.concat(acc["out"], F.substring(text, acc["pos"] + 1, F.length(text))))
    new = F.when(F.size(spans) == 0, F.col("__row")[text_col]).otherwise(done)
    return df.select(*[(new if c == text_col else F.col("__row")[c]).alias(c) for c in docs.columns])
