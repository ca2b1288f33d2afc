"""Personal data by candidate gradient boosting, in DataFrame functions only.

Base spans come from four exact patterns with their checks and always stay.
The text with these spans blanked out goes to high-recall generators, which
propose further spans that may overlap each other (spelled-out addresses,
numbers without the plus sign, other separators). Each candidate has yes/no
features of its format, of its content and of the text on either side. Boosted
trees are fitted on labelled cases (``pii_cases``, a bounded set made from
rules, whose labels come from what a case was made as, never from a feature):
all spellings that count, and numbers and phrases that look alike and do not,
such as order numbers, versions, dates, measures and lists. The threshold of
each kind is calibrated on the cases held back, to a target precision.
Candidates above it are added, of those that overlap the better.

A row's spans stay in arrays of that row: texts are read once and nothing is
shuffled. Places are summed up in chunks and overlaps are swept in order, so a
text with very many matches costs little more than in proportion. The
patterns' repeats are possessive where a shorter match could not help, so that
long texts cost no backtracking.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import boosting, pii_cases

KINDS = ["email", "ip", "card", "phone"]
# Calibrated share of positives among labelled candidates from which on a span is redacted.
PRECISION = 0.9
# Code points of context on either side, matches summed up at a time.
CONTEXT_BEFORE, CONTEXT_AFTER = 24, 8
CHUNK = 256
# Stands for a character of a base span in the text that the generators read.
BLANK = "\x00"

# The four base patterns. A run of an e-mail's first characters is tried from
# its start (or the end of the match before) only, which finds the same matches.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# What a text must hold for its base pattern to match at all.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}

# Generators: kind, pattern, what the text must match to be searched.
_AT = r"(?: ?(?:@|[(\[{] ?[aA][tT] ?[)\]}]) ?| (?:at|AT) (?=[A-Za-z0-9-]++(?: (?:dot|DOT) |\.[A-Za-z])))"
_DOT = r"(?:\.| \. (?![A-Z][a-z])| ?[(\[{] ?(?:[dD][oO][tT]|\.) ?[)\]}] ?| (?:dot|DOT) )"
GENERATORS = [
    # a dot with a space on one side is taken only where no other dot follows the host, as it mostly ends a sentence
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++" + _AT + r"[A-Za-z0-9-]++"
              r"(?:(?:" + _DOT + r"[A-Za-z0-9-]++)++|(?: ?\. ?[A-Za-z0-9-]++)++)",
     r"@|[(\[{] ?[aA][tT] ?[)\]}]| at | AT "),
    ("ip", r"(?<![0-9A-Za-z.])[0-9]{1,3}+(?:(?:\.| \. |\[\.\]|\(\.\)| dot )[0-9]{1,3}+){3}(?!(?:\.| \. |\[\.\]|\(\.\)| dot )?[0-9])", r"[0-9]"),
    ("card", r"(?<![0-9])[0-9](?:[ ._/-]{0,2}+[0-9]){11,22}+", r"[0-9]"),
    ("phone", r"(?:\+|(?<![0-9A-Za-z+]))(?:\([0-9]{1,4}+\)|[0-9]{1,4}+)(?:[ ./-]{1,2}+(?:\([0-9]{2,8}+\)|[0-9]{2,8}+)){1,5}+(?![0-9])", r"[0-9]"),
]

# Cues: words right before a candidate that announce personal data, or another kind of number.
PERSONAL = r"(?i)(?:tel|phone|call|fax|mobile|cell|ring|dial|text|mail|write|contact|reach|me on|card|visa|mastercard|account|iban|ip|address|host|server|from)[^A-Za-z0-9]*+(?:(?:is|me|us|to|at|on|no|number)[^A-Za-z0-9]*+)?$"
COUNTER = r"(?i)(?:order|invoice|ref|reference|ticket|part|serial|model|version|ver|release|build|isbn|issn|section|chapter|page|pages|tracking|ssn|code|case|item|sku|id|batch|numbers|table|sum|total|score|meet|article|figure|v)[^A-Za-z0-9]*+(?:(?:is|no|nr|number|id)[^A-Za-z0-9]*+)?$"
UNIT = r"(?i)^ ?(?:%|€|\$|°|(?:kg|g|km|m|cm|mm|l|ml|eur|usd|gbp|mb|gb|kb|ms|min|pieces|units|people|inhabitants|points|votes)\b)"
DATE = r"^(?:(?:19|20)[0-9]{2}([./ -])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([./ -])[0-9]{1,2}\2(?:19|20)[0-9]{2})(?![0-9])"
THOUSANDS = r"^[1-9][0-9]{0,2}([ .])[0-9]{3}(?:\1[0-9]{3})+$"
DOMAIN = r"(?i)(?:^|[^a-z])(?:com|org|net|edu|gov|info|io|[a-z]{2})$"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _pieces(text: Column, pattern: str) -> Column:
    """Per match what was found and what lies between it and its neighbours:
    array<struct<found, before, after>>."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    zipped = _let(between, lambda b: F.arrays_zip(found.alias("found"), b.alias("before"), F.slice(b, 2, F.size(b)).alias("after")))
    return F.filter(zipped, lambda m: m["found"].isNotNull())


_SPAN = "array<struct<s:int,e:int,t:string,b:string,a:string>>"


def _positions(pieces: Column) -> Column:
    """Matches with their places in code points, end exclusive, and the context
    up to their neighbours: array<struct<s, e, t, b, a>>. Places are summed
    inside chunks, then over chunks, so no array is copied match by match."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def one(acc, m):
        s = acc["at"] + F.length(m["before"])
        e = s + F.length(m["found"])
        span = F.struct(s.alias("s"), e.alias("e"), m["found"].alias("t"),
                        F.substring(m["before"], -CONTEXT_BEFORE, CONTEXT_BEFORE).alias("b"),
                        F.substring(m["after"], 1, CONTEXT_AFTER).alias("a"))
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    def shifted(acc, c):
        moved = F.transform(c["out"], lambda m: F.struct((m["s"] + acc["at"]).alias("s"), (m["e"] + acc["at"]).alias("e"),
                                                         m["t"].alias("t"), m["b"].alias("b"), m["a"].alias("a")))
        return F.struct((acc["at"] + c["at"]).alias("at"), F.concat(acc["out"], moved).alias("out"))

    chunks = _let(pieces, lambda p: F.transform(F.sequence(F.lit(0), F.floor((F.greatest(F.size(p), F.lit(1)) - 1) / CHUNK).cast("int")),
                                                lambda k: F.slice(p, k * CHUNK + 1, F.lit(CHUNK))))
    return F.aggregate(F.transform(chunks, lambda c: F.aggregate(c, start, one)), start, shifted, lambda acc: acc["out"])


def _none() -> Column:
    return F.array().cast("array<struct<s:int,e:int>>")


def _digits(t: Column) -> Column:
    return F.regexp_replace(t, "[^0-9]", "")


def luhn(t: Column) -> Column:
    """Whether the digits of ``t`` pass the check sum."""
    d = F.filter(F.split(F.reverse(_digits(t)), ""), lambda x: x != "")
    value = lambda x, i: x.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
    total = F.aggregate(F.transform(d, lambda x, i: F.when(value(x, i) > 9, value(x, i) - 9).otherwise(value(x, i))),
                        F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def _holds(kind: str, t: Column) -> Column:
    """Whether a match of a base pattern passes the check of its kind."""
    n = F.length(_digits(t))
    if kind == "ip":
        return t.rlike(r"^(?:0*+(?:[0-9]?[0-9]?|1[0-9][0-9]|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$")
    if kind == "card":
        return n.between(16, 19) & luhn(t)
    if kind == "phone":
        return n.between(8, 15)
    return F.lit(True)


def _may(text: Column, kind: str) -> Column:
    may = F.contains(text, F.lit(NEEDS[kind])) if NEEDS[kind] else F.lit(True)
    return may if kind == "email" else may & text.rlike("[0-9]")


def base_spans(text: Column, kind: str) -> Column:
    """The exact spans of a kind, leftmost and non-overlapping."""
    held = F.filter(_positions(_pieces(text, BASE[kind])), lambda m: _holds(kind, m["t"]))
    return F.when(_may(text, kind), F.transform(held, lambda m: F.struct(m["s"].alias("s"), m["e"].alias("e")))).otherwise(_none())


def blanked(text: Column, kind: str) -> Column:
    """``text`` with the base spans of a kind blanked out, as long as before."""
    def keep(p):
        parts = F.transform(p, lambda m: F.concat(m["before"], F.when(_holds(kind, m["found"]), F.repeat(F.lit(BLANK), F.length(m["found"])))
                                                  .otherwise(m["found"])))
        return F.concat(F.array_join(parts, ""), F.coalesce(F.get(p, F.size(p) - 1)["after"], F.lit("")))

    return _let(_pieces(text, BASE[kind]), lambda p: F.when(F.size(p) > 0, keep(p)).otherwise(text))


def _mask(kind: str, m: Column) -> Column:
    """The features of a candidate as bits: kind, context, content, format."""
    t, before, after = m["t"], m["b"], m["a"]
    digits = F.length(_digits(t))
    form = F.lit(False)
    if kind == "email":
        plain = F.regexp_replace(F.regexp_replace(t, r"(?i) ?(?:@|[(\[{] ?at ?[)\]}]| at ) ?", "@"), r"(?i) ?[(\[{] ?(?:dot|\.) ?[)\]}] ?| \. | dot ", ".")
        form = plain.rlike(r"^[^@ ]++@(?:[A-Za-z0-9-]++\.)++[A-Za-z][A-Za-z0-9-]*+$")
    if kind == "card":
        form = digits.between(16, 19) & luhn(t)
    if kind == "phone":
        form = digits.between(8, 15) & ~t.rlike("^[0-9]{4}[._/][0-9]{4}")
    if kind == "ip":
        form = F.forall(F.filter(F.split(t, "[^0-9]+"), lambda x: x != ""), lambda x: x.cast("int") <= 255)
    bits = [F.lit(kind == k) for k in KINDS] + [
        before.rlike(PERSONAL), before.rlike(COUNTER), before.rlike(r"(?:^|[\s\"'(=:,;>])$"),
        (after == "") | after.rlike(r"^[\s.,;!?)\"'%&*#$<\x00]"), after.rlike(UNIT),
        digits.between(8, 15), digits.between(16, 19), luhn(t) & (digits >= 12), form,
        t.rlike(DOMAIN), t.rlike(r"(?i)[(\[{] ?(?:at|dot|\.) ?[)\]}]|@") | t.rlike(r" AT .* DOT "), t.rlike(DATE), t.rlike(THOUSANDS),
        t.rlike(r"^(?:\+|00|0[1-9]|\()"), t.rlike(r"^[0-9]{1,2}(?:[ ./-]+[0-9]{1,2})+$"), t.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"),
        t.rlike(r"^[0-9]{4}(?:[ -][0-9]{4})+$"), t.rlike(r"^(?:1[ .-])?[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}$")]
    assert len(bits) == FEATURES
    out = F.lit(0).cast("long")
    for i, b in enumerate(bits):
        out = out + F.when(b, F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
    return out


# Bits of a mask; the first four are the kind.
FEATURES = 22


def _described(kind: str):
    return lambda m: F.struct(F.lit(KINDS.index(kind)).alias("kind"), m["s"].alias("s"), m["e"].alias("e"), _mask(kind, m).alias("mask"))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, cand) per row: base is an array of arrays of spans by kind,
    cand the proposed spans with their features. The generators read the text
    with one kind of base spans after the other blanked out."""
    d = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    d = d.withColumn("rest", F.col("text"))
    for k in KINDS:
        d = d.withColumn(k, base_spans(F.col("text"), k))
        d = d.withColumn("rest", F.when(F.size(k) > 0, blanked(F.col("rest"), k)).otherwise(F.col("rest")))
    lists = []
    for kind, pattern, need in GENERATORS:
        raw = _positions(_pieces(F.col("rest"), pattern))
        described = F.transform(raw, _described(kind))
        none = F.array().cast("array<struct<kind:int,s:int,e:int,mask:bigint>>")
        lists.append(F.when(F.col("rest").rlike(need), described).otherwise(none))
    return d.select("id", F.array(*KINDS).alias("base"), F.concat(*lists).alias("cand"))


def fit(spark: SparkSession, precision: float = PRECISION, cases: int = pii_cases.CASES) -> tuple[boosting.Boosted, list[float]]:
    """Trees and each kind's threshold from the labelled cases (at most
    ``cases`` of a format; three in four to fit, the others to calibrate)."""
    made = pii_cases.make(cases)
    d = spark.createDataFrame([(i, c.text) for i, c in enumerate(made)], "doc_id long, text string")
    found = [(made[x["id"]], r) for x in candidates(d).select("id", "cand").collect() for r in x["cand"]]
    counts: list[dict[int, list[float]]] = [{}, {}]
    for c, r in found:
        if (r["s"], r["e"]) != (c.start, c.end):
            continue  # not the case, but a part of it or of the words around
        hit = KINDS[r["kind"]] == c.kind
        t = counts[c.number % 4 == 0].setdefault(r["mask"], [0.0, 0.0])
        t[0], t[1] = t[0] + hit, t[1] + (not hit)

    def table(n: int):
        rows = sorted((m, *t) for m, t in counts[n].items())
        return tuple(np.array([r[i] for r in rows], dtype=kind) for i, kind in enumerate((np.int64, float, float)))

    mask, pos, neg = table(0)
    model = boosting.fit(mask, pos, neg, FEATURES)
    mask, pos, neg = table(1)
    cuts = []
    for k in range(len(KINDS)):
        own = (mask >> k) & 1 == 1
        cuts.append(boosting.threshold(model.raw(mask[own]), pos[own], neg[own], precision))
    return model, cuts


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", precision: float = PRECISION) -> DataFrame:
    """(id, base, spans): base spans by kind, and by kind all spans in order of
    start. Null counts as empty; a row without a match has empty arrays."""
    model, cuts = fit(docs.sparkSession, precision)
    cut = "case " + " ".join(f"when c.kind = {k} then {v!r}D" for k, v in enumerate(cuts) if v != float("inf")) + " end"
    if all(v == float("inf") for v in cuts):
        cut = "cast(null as double)"
    scored = f"transform(cand, c -> named_struct('s', c.s, 'kind', c.kind, 'e', c.e, 'score', {model.sql('c.mask')}, 'cut', {cut}))"
    d = candidates(docs, id_col, text_col).select("id", "base", F.expr(f"array_sort(filter({scored}, c -> c.score >= c.cut))").alias("more"))
    # in order of start: of two that overlap the better stays, the earlier one if they are alike
    one = d.schema["more"].dataType.elementType.simpleString()
    step = ("case when a.last is null then named_struct('last', c, 'out', a.out) "
            "when c.s >= a.last.e then named_struct('last', c, 'out', concat(a.out, array(a.last))) "
            "when c.score > a.last.score then named_struct('last', c, 'out', a.out) else a end")
    d = d.withColumn("kept", F.expr(
        f"aggregate(more, named_struct('last', cast(null as {one}), 'out', cast(array() as array<{one}>)), (a, c) -> {step}, "
        "a -> if(a.last is null, a.out, concat(a.out, array(a.last))))"))
    kinds = [F.expr(f"array_sort(concat(base[{k}], transform(filter(kept, c -> c.kind = {k}), c -> named_struct('s', c.s, 'e', c.e))))")
             for k in range(len(KINDS))]
    return d.select("id", "base", F.array(*kinds).alias("spans"))


def span_text(spans: str) -> Column:
    """kind:start:end by kind, then start, comma-joined."""
    parts = [F.expr(f"transform({spans}[{k}], m -> concat_ws(':', '{name}', cast(m.s as string), cast(m.e as string)))")
             for k, name in enumerate(KINDS)]
    return F.array_join(F.concat(*parts), ",")
