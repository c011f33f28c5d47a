"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score. Column expressions only.

Every kind has a pattern and a validator. Places follow from cutting the text at the matches: a match starts where the pieces and
matches before it end, counted in code points. Patterns are possessive and begin at the start of a run (or where the last match
ended), so a run of a million digits or letters is read once and nothing is retried. An IBAN has the length of its country
(IBAN_LENGTHS), so its match ends where the IBAN ends; other countries' are as long as the run. IBANs are looked for from every start
of a word, each at most 34 characters ahead: one that the checksum rejects hides none that begins within it, and if two overlap and
both are confirmed, both count.

The kinds email, ip, card and phone are the base: a confirmed base span always counts. The method adds IBANs (mod-97): their score
is CONFIRMED plus NEARBY for a word that speaks of an account within WINDOW code points; a span counts from THRESHOLD on. Scores of
base spans are adjusted the same way and reported.

Null text: no spans; an empty text likewise. Kinds are searched independently, so spans of different kinds may overlap; redact()
then hides their union. Rows are never grouped, so repeated rows and null ids stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pcmarts.llm.common import let

WINDOW, THRESHOLD, CONFIRMED, NEARBY = 40, 0.5, 0.6, 0.3
PREFIX_BLOCK = 256

# What each kind looks like, what must occur in a text before the pattern is tried, and words that speak for it.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban() -> str:
    """An IBAN by country and length, single spaces anywhere after the check digits; of other countries, groups of four or one run."""
    known = "|".join(f"(?:{'|'.join(names.split())})[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{size - 4}}}" for size, names in IBAN_LENGTHS.items())
    names = "|".join(" ".join(IBAN_LENGTHS.values()).split())
    other = rf"(?!{names})[A-Z]{{2}}[0-9]{{2}}(?:(?:\x20[A-Z0-9]{{4}}){{2,7}}(?:\x20[A-Z0-9]{{1,4}})?|[A-Z0-9]{{11,30}})"
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?=((?:{known}|{other})(?![A-Za-z0-9])))"


KINDS = ("email", "ip", "card", "phone", "iban")
BASE = KINDS[:4]
PATTERN = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": _iban(),
}
OCCURS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]", "iban": r"[A-Z]{2}[0-9]{2}"}
WORDS = {
    "email": "mail|contact|write to", "ip": r"\bip\b|address|host|server", "card": "card|visa|credit|debit|karte|tarjeta|carte",
    "phone": r"phone|call|tel\b|mobile|fax", "iban": r"iban|account|bank|konto|compte|cuenta|\bbic\b",
}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def _running(values: Column) -> Column:
    """Inclusive running sums of an array, in two levels so that the cost stays near-linear."""

    def plain(xs: Column) -> Column:
        start = F.array().cast("array<bigint>")
        return F.aggregate(xs, start, lambda acc, x: F.concat(acc, F.array(F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0)) + x)))

    def whole(xs: Column) -> Column:
        starts = F.sequence(F.lit(0), F.ceil(F.size(xs) / PREFIX_BLOCK).cast("int") - 1)
        blocks = F.transform(starts, lambda i: plain(F.slice(xs, i * PREFIX_BLOCK + 1, F.lit(PREFIX_BLOCK))))

        def shifted(bs: Column) -> Column:
            totals = plain(F.transform(bs, lambda b: F.get(b, F.size(b) - 1)))
            lift = lambda ts: F.transform(bs, lambda b, i: let(F.coalesce(F.get(ts, i - 1), F.lit(0)), lambda t: F.transform(b, lambda x: x + t)))
            return F.flatten(let(totals, lift))

        return F.when(F.size(xs) == 0, F.array().cast("array<bigint>")).otherwise(let(blocks, shifted))

    return let(values, whole)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(text: Column) -> Column:
    """Whether the digits in text pass the Luhn check."""
    places = F.split(F.reverse(_digits(text)), "")

    def total(ds: Column) -> Column:
        doubled = lambda d, i: F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))
        return F.aggregate(F.transform(ds, lambda c, i: doubled(F.ascii(c) - 48, i)), F.lit(0), lambda acc, x: acc + x)

    return let(places, total) % 10 == 0


def mod97(text: Column) -> Column:
    """Whether an IBAN's check digits hold: moved to the end, letters as 10..35, the number leaves 1 when divided by 97."""
    plain = F.regexp_replace(text, r"\x20", "")
    chars = F.split(let(plain, lambda p: F.concat(F.substr(p, F.lit(5)), F.substr(p, F.lit(1), F.lit(4)))), "")
    value = lambda acc, c: F.when(F.ascii(c) < 58, acc * 10 + F.ascii(c) - 48).otherwise(acc * 100 + F.ascii(c) - 55) % 97
    return F.aggregate(chars, F.lit(0), value) == 1


def confirmed(kind: str, text: Column) -> Column:
    """The validator of a kind, for a match of its pattern."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return text.rlike(rf"^(?:{OCTET}\.){{3}}{OCTET}$")
    if kind == "card":
        return F.length(_digits(text)).between(14, 19) & luhn(text)
    if kind == "phone":
        return F.length(_digits(text)).between(10, 15)
    return F.length(F.regexp_replace(text, r"\x20", "")).between(15, 34) & mod97(text)


SPAN = "struct<kind_no:int,kind:string,start:bigint,end:bigint,score:double>"


def _spans_of(kind: str, text: Column) -> Column:
    """Confirmed spans of one kind that reach the threshold, in the order of the text."""
    none = F.array().cast(f"array<{SPAN}>")

    def placed(found: Column) -> Column:
        matches, pieces = found["matches"], found["pieces"]
        ends = _running(F.transform(matches, lambda m, i: F.length(F.get(pieces, i)).cast("bigint") + F.length(m)))

        def span(m: Column, i: Column, es: Column) -> Column:
            near = F.lower(F.concat_ws(" ", F.right(F.get(pieces, i), F.lit(WINDOW)), F.left(F.get(pieces, i + 1), F.lit(WINDOW))))
            score = F.lit(CONFIRMED) + F.when(near.rlike(WORDS[kind]), NEARBY).otherwise(0.0)
            end = F.get(es, i)
            return F.when(confirmed(kind, m), F.struct(
                F.lit(KINDS.index(kind)).alias("kind_no"), F.lit(kind).alias("kind"), (end - F.length(m)).alias("start"), end.alias("end"),
                score.alias("score"),
            ).cast(SPAN))

        return let(ends, lambda es: F.filter(F.transform(matches, lambda m, i: span(m, i, es)), lambda s: s.isNotNull() & ((s["kind_no"] < len(BASE)) | (s["score"] >= THRESHOLD))))

    if kind == "iban":
        return F.when(text.rlike(OCCURS[kind]), let(_candidates(text), _ibans)).otherwise(none)
    found = F.struct(F.regexp_extract_all(text, F.lit(PATTERN[kind]), F.lit(0)).alias("matches"), F.split(text, PATTERN[kind], -1).alias("pieces"))
    seen = text.contains("@") if kind == "email" else text.rlike(OCCURS[kind])
    return F.when(seen, let(found, placed)).otherwise(none)


def _candidates(text: Column) -> Column:
    """What may be an IBAN, overlapping ones too: matches, and the pieces of the text that start with them, after the piece before all."""
    pieces = F.split(text, PATTERN["iban"], -1)
    matches = F.regexp_extract_all(text, F.lit(PATTERN["iban"]), F.lit(1))
    # A match at the very start of the text cuts off no empty piece.
    led = let(pieces, lambda ps: F.when(F.size(ps) > F.size(matches), ps).otherwise(F.concat(F.array(F.lit("")), ps)))
    return F.struct(matches.alias("matches"), led.alias("pieces"))


def _ibans(found: Column) -> Column:
    """Confirmed spans of the candidates that reach the threshold, overlapping ones too."""
    matches, pieces = found["matches"], found["pieces"]
    starts = _running(F.transform(matches, lambda m, i: F.length(F.get(pieces, i)).cast("bigint")))

    def span(m: Column, i: Column, ss: Column) -> Column:
        near = F.lower(F.concat_ws(" ", F.right(F.get(pieces, i), F.lit(WINDOW)), F.substr(F.get(pieces, i + 1), F.length(m) + 1, F.lit(WINDOW))))
        score = F.lit(CONFIRMED) + F.when(near.rlike(WORDS["iban"]), NEARBY).otherwise(0.0)
        return F.when(confirmed("iban", m), F.struct(
            F.lit(KINDS.index("iban")).alias("kind_no"), F.lit("iban").alias("kind"), F.get(ss, i).alias("start"), (F.get(ss, i) + F.length(m)).alias("end"),
            score.alias("score"),
        ).cast(SPAN))

    return let(starts, lambda ss: F.filter(F.transform(matches, lambda m, i: span(m, i, ss)), lambda s: s.isNotNull() & (s["score"] >= THRESHOLD)))


def with_spans(docs: DataFrame, text: str = "text", into: str = "spans") -> DataFrame:
    """docs with an array of (kind_no, kind, start, end, score), by start, then kind; places in code points, end exclusive."""
    each = F.concat(*(_spans_of(kind, F.coalesce(F.col(text), F.lit(""))) for kind in KINDS))
    ordered = lambda a, b: F.when(a["start"] != b["start"], F.signum(a["start"] - b["start"])).otherwise(a["kind_no"] - b["kind_no"]).cast("int")
    return docs.withColumn(into, F.array_sort(each, ordered))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with every span replaced by its kind in brackets, [EMAIL]; overlapping spans become one, named after the first.

    A null text stays null. n_chars, if there, is set to the new length (null for a null text).
    """
    start = F.struct(F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>").alias("done"), F.lit(-1).cast("bigint").alias("end"))

    def merge(acc: Column, s: Column) -> Column:
        done = acc["done"]
        last = F.get(done, F.size(done) - 1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))
        joined = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer))
        added = F.concat(done, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
        return F.struct(F.when(s["start"] < acc["end"], joined).otherwise(added).alias("done"), F.greatest(acc["end"], s["end"]).alias("end"))

    whole = F.col(text)
    cut = lambda lo, hi: F.substr(whole, (lo + 1).cast("int"), (hi - lo).cast("int"))

    def rebuilt(parts: Column) -> Column:
        before = lambda s, i: F.concat(cut(F.coalesce(F.get(parts, i - 1)["end"], F.lit(0)), s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.concat(F.array_join(F.transform(parts, before), ""), cut(F.get(parts, F.size(parts) - 1)["end"], F.length(whole).cast("bigint")))

    parts = F.aggregate(F.col("_pii_spans"), start, merge)["done"]
    out = with_spans(docs, text, "_pii_spans").withColumn("_pii_text", F.when(F.size("_pii_spans") == 0, whole).otherwise(let(parts, rebuilt)))
    columns = {text: F.col("_pii_text")} | ({"n_chars": F.length("_pii_text").cast("long")} if "n_chars" in docs.columns else {})
    return out.select(*(columns[c].alias(c) if c in columns else F.col(c) for c in docs.columns))
