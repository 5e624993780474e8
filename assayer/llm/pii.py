"""Personal data: regular expressions propose spans, checksums confirm them, context words
adjust their score.

Everything is built-in SQL functions over one row's text.  A pattern is run twice, as
``split`` and as ``regexp_extract_all``: the pieces between the matches give both the
positions (in code points, end exclusive) and the context before and after each match.
The patterns never start twice in one run of characters and never backtrack into a run, so
their time is linear in the text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEAR = 40
NAME = "A-Za-z0-9._%+-"
DIGITS = "regexp_replace(m, '[^0-9]', '')"
PARTS_FIT = (
    "forall(split(m, '[.]'), p -> length(ltrim('0', p)) <= 3 "
    "and coalesce(try_cast(ltrim('0', p) as int), 0) <= 255)"
)
LUHN = (
    "aggregate(transform(sequence(1, length({d})), i -> cast(substring({d}, -i, 1) as int) * (2 - i % 2)), "
    "0, (s, v) -> s + if(v > 9, v - 9, v)) % 10 = 0"
)
MOD97 = (
    "aggregate(sequence(1, length({d})), 0, (s, i) -> if(substring({d}, i, 1) between '0' and '9', "
    "(s * 10 + cast(substring({d}, i, 1) as int)) % 97, "
    "(s * 100 + ascii(substring({d}, i, 1)) - 55) % 97)) = 1"
)


@dataclass(frozen=True)
class Kind:
    """``pattern``: Java regex; ``guard``: a cheap test of the whole text ``t`` without
    which nothing can match; ``valid``: test of a match ``m``; ``score`` of a valid match,
    ``near_score`` more if one of ``context`` is within NEAR characters; spans under
    ``least`` are dropped."""

    name: str
    pattern: str
    guard: str
    valid: str
    score: float
    context: tuple[str, ...] = ()
    near_score: float = 0.2
    least: float = 0.0


BASE = (
    Kind(
        "email",
        rf"(?:\G|(?<![{NAME}]))[{NAME}]++@[A-Za-z0-9-]++(?:[.][A-Za-z0-9-]++)++",
        "contains(t, '@')", "true", 0.7, ("mail", "contact", "write to"),
    ),
    Kind(
        "ip", r"(?:\G|(?<![0-9]))[0-9]++[.][0-9]++[.][0-9]++[.][0-9]++",
        "contains(t, '.')", PARTS_FIT, 0.6, ("ip", "address", "host", "server"),
    ),
    Kind(
        "card", r"[0-9]++(?:[\x20-][0-9]++)*+", "t rlike '[0-9](?:[ -]?[0-9]){15}'",
        f"length({DIGITS}) between 16 and 19 and {LUHN.format(d=DIGITS)}",
        0.8, ("card", "visa", "credit", "payment"),
    ),
    Kind(
        "phone", r"[+][0-9][\x20().0-9-]+[0-9]", "contains(t, '+')",
        f"length({DIGITS}) between 8 and 15", 0.5, ("phone", "call", "tel", "mobile"),
    ),
)
IBAN_TEXT = "replace(m, ' ', '')"
#: Countries by the length of their IBANs, so that what follows a number is not read with it.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
IBAN_OF = "|".join(
    rf"(?:{names.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])" for n, names in IBAN_LENGTHS.items()
)
ADDED = (
    Kind(
        "iban",
        rf"(?<![A-Za-z0-9])(?:{IBAN_OF}|[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}}(?![A-Za-z0-9]))",
        "t rlike '[A-Z]{2}[0-9]{2}'",
        MOD97.format(d=f"concat(substring({IBAN_TEXT}, 5), substring({IBAN_TEXT}, 1, 4))"),
        0.8, ("iban", "account", "bank"), 0.2, 0.5,
    ),
    Kind(
        "ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "t rlike '[0-9]-[0-9]{2}-[0-9]'",
        "true", 0.3, ("ssn", "social security"), 0.4, 0.5,
    ),
)
KINDS = BASE + ADDED
NO_SPANS = "cast(array() as array<struct<kind:string,start:int,end:int,score:double>>)"


def spans_of(text: str, kind: Kind) -> Column:
    """Array of (kind, start, end, score) in the order of their starts."""
    pattern = kind.pattern.replace("\\", "\\\\")
    near = " or ".join(f"contains(near, '{w}')" for w in kind.context) or "false"
    near_text = f"lower(concat(right(x.g[i], {NEAR}), ' ', left(x.g[i + 1], {NEAR})))"
    one = (
        f"struct('{kind.name}' as kind, a.at + length(x.g[i]) as start, "
        "a.at + length(x.g[i]) + length(x.m[i]) as end, "
        f"{kind.score}D + if(exists(array({near_text}), near -> {near}), {kind.near_score}D, 0D) as score)"
    )
    kept = f"filter(array({one}), s -> s.score >= {kind.least}D)"
    valid = f"exists(array(x.m[i]), m -> {kind.valid})"
    fold = (
        f"aggregate(sequence(0, size(x.m) - 1), struct(0 as at, {NO_SPANS} as found), (a, i) -> "
        "struct(a.at + length(x.g[i]) + length(x.m[i]) as at, "
        f"if({valid}, concat(a.found, {kept}), a.found) as found), a -> a.found)"
    )
    # an array of one struct binds both results, so that each pattern runs once a text
    return F.expr(
        f"exists(array({text}), t -> {kind.guard})"
    ), F.expr(
        f"element_at(transform(array(struct(regexp_extract_all({text}, '{pattern}', 0) as m, "
        f"split({text}, '{pattern}', -1) as g)), x -> if(size(x.m) = 0, {NO_SPANS}, {fold})), 1)"
    )


def with_spans(
    docs: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = KINDS, *, to: str = "spans"
) -> DataFrame:
    """``docs`` with the column ``to``: spans of all kinds in the order listed, each by start.

    Null and empty texts have no spans.  Repeated rows each get theirs.  An existing column
    of that name is replaced; other columns stay.
    """
    found = []
    for kind in kinds:
        guard, spans = spans_of("__text", kind)
        found.append(F.when(guard, spans).otherwise(F.expr(NO_SPANS)))
    return (
        docs.withColumn("__text", F.coalesce(F.col(text), F.lit("")))
        .withColumn(to, F.concat(*found)).drop("__text")
    )


def redacted(docs: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets.  Spans that
    overlap are replaced as one, under the kind of the first.  Texts without spans, null
    included, stay as they are; a column ``n_chars`` is renewed where the text changes."""
    order = (
        "array_sort(__spans, (l, r) -> case when l.start < r.start then -1 when l.start > r.start "
        "then 1 when l.end > r.end then -1 when l.end < r.end then 1 else 0 end)"
    )
    fold = (
        f"aggregate({order}, struct(0 as at, cast(array() as array<string>) as out), (a, s) -> "
        "if(s.start < a.at, struct(greatest(a.at, s.end) as at, a.out as out), "
        f"struct(s.end as at, concat(a.out, array(substring({text}, a.at + 1, s.start - a.at), "
        "concat('[', upper(s.kind), ']'))) as out)), "
        f"a -> concat(array_join(a.out, ''), substring({text}, a.at + 1)))"
    )
    found = with_spans(docs, text, kinds, to="__spans")
    changed = F.size("__spans") > 0
    new = {text: F.when(changed, F.expr(fold)).otherwise(F.col(text))}
    if "n_chars" in docs.columns:
        new["__n"] = F.when(changed, F.length(F.expr(fold)).cast("long")).otherwise(F.col("n_chars"))
        return found.withColumns(new).drop("n_chars").withColumnRenamed("__n", "n_chars").select(docs.columns)
    return found.withColumns(new).select(docs.columns)


def joined(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')")


def report(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, the digest of the base spans, all spans."""
    base = ", ".join(f"'{k.name}'" for k in BASE)
    found = with_spans(docs.select("doc_id", "text")).drop("text")
    counts = {
        f"n_{k.name}": F.expr(f"cast(size(filter(spans, s -> s.kind = '{k.name}')) as bigint)") for k in BASE
    }
    return found.select(
        "doc_id", *[c.alias(n) for n, c in counts.items()],
        F.sha2(joined(f"filter(spans, s -> s.kind in ({base}))"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )
