"""Spans of personal data by weak supervision, in built-in Spark functions only.

Patterns find candidates: the base forms of e-mail addresses, IP addresses, card and
phone numbers, and looser forms. Labelers vote on each candidate: its pattern's own check,
its shape, a gazetteer (mail providers and top-level domains, address ranges, issuer prefixes with
lengths, country codes with lengths) and the words before it.
Votes are counted by combination over the whole corpus, which is a table of bounded
size; expectation-maximisation on these counts gives each labeler's reliability and each
combination's chance to be personal data; with these chances a naive Bayes classifier
over features of the span is trained on the same counts. Base spans that pass their check
always stay; a looser candidate is added if the classifier finds it likelier than not,
it passes its kind's check and it does not overlap a base span. Base matches that fail their check are examples to
learn from and are never added.

The text is scanned by each pattern only if a cheap test finds what the pattern needs,
and patterns begin at the edges of character runs and never give characters back, so
their time is in proportion to the text.

Spans are code points, end exclusive. Defined results: a null or empty text has no spans;
repeated rows each get theirs; an empty table gives no rows; columns of the
input are kept, and ones named like an added column are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.once import bind, with_once
from ledgerloom.llm.store import stored

KINDS = ("email", "ip", "card", "phone")
CONTEXT_CHARS = 40
EM_ROUNDS = 40
BLOCK = 64
_SPANS = "array<struct<start:bigint,kind:int,end:bigint,base:boolean,votes:array<int>,features:array<int>>>"


@dataclass(frozen=True)
class Form:
    """A pattern for candidates of one kind. ``needs`` is a cheap test a text must pass."""

    name: str
    kind: str
    needs: str
    pattern: str
    base: bool = False


_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
FORMS = (
    Form("email", "email", "@", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++", base=True),
    Form("ip", "ip", r"[0-9]\.[0-9]", r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}", base=True),
    Form("card", "card", r"[0-9](?:[\x20-]?[0-9]){13}", r"[0-9](?:[\x20-]?[0-9])++", base=True),
    Form("phone", "phone", r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", base=True),
    Form(
        "email_spelled",
        "email",
        r"[\[(]at[\])]",
        rf"(?<!{_LOCAL}){_LOCAL}++\x20?[\[(]at[\])]\x20?{_HOST}++(?:\x20?(?:\.|[\[(]dot[\])])\x20?{_HOST}++)++",
    ),
    Form(
        "ip_long",
        "ip",
        r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:",
        r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:.])",
    ),
    Form(
        "card_grouped",
        "card",
        r"[0-9]{4}[\x20-][0-9]{4}[\x20-]",
        r"(?<![0-9])[0-9]{4}(?:[\x20-][0-9]{4}){3}(?![0-9])",
    ),
    Form(
        "phone_local",
        "phone",
        r"[0-9]{3}[)]?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}",
        r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
    ),
)

_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Words before a span that speak for a kind, in the corpus's languages.
CONTEXT = {
    "email": r"(?i)\b(e-?mail|mail|contact|kontakt|correo|courriel|write|reply)\b",
    "ip": r"(?i)\b(ip|host|server|address|adresse|dirección|client|node)\b",
    "card": r"(?i)\b(card|visa|mastercard|credit|karte|carte|tarjeta|payment)\b",
    "phone": r"(?i)\b(phone|tel|telephone|telefon|téléphone|teléfono|mobile|call|fax)\b",
}
AGAINST = r"(?i)\b(version|isbn|issn|invoice|order|page|section|build|serial|rev|doi)\b"
#: Mail providers, and top-level domains besides those of two letters.
PROVIDERS = (
    "aol", "fastmail", "free", "freenet", "gmail", "gmx", "googlemail", "hotmail", "icloud", "laposte", "live", "mac",
    "mail", "me", "msn", "orange", "outlook", "posteo", "proton", "protonmail", "qq", "sfr", "t-online", "terra",
    "wanadoo", "web", "yahoo", "yandex", "zoho",
)
DOMAINS = ("com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "name", "dev", "app", "cloud", "online", "site")
#: Address ranges that name no host on the public network: (first parts, how far the next part goes).
SPECIAL_RANGES = (
    ("0", 0, 255), ("10", 0, 255), ("100", 64, 127), ("127", 0, 255), ("169", 254, 254), ("172", 16, 31),
    ("192.0", 0, 0), ("192.0", 2, 2), ("192.88", 99, 99), ("192", 168, 168), ("198", 18, 19), ("198.51", 100, 100),
    ("203.0", 113, 113), ("", 224, 255),
)
#: Card issuers: (first and last prefix, lengths).
ISSUERS = (
    ("4", "4", (13, 16, 19)), ("51", "55", (16,)), ("2221", "2720", (16,)), ("34", "34", (15,)), ("37", "37", (15,)),
    ("6011", "6011", (16, 17, 18, 19)), ("644", "649", (16, 17, 18, 19)), ("65", "65", (16, 17, 18, 19)),
    ("300", "305", (14, 15, 16, 17, 18, 19)), ("36", "36", (14, 15, 16, 17, 18, 19)), ("38", "39", (16, 17, 18, 19)),
    ("3528", "3589", (16, 17, 18, 19)), ("62", "62", (16, 17, 18, 19)), ("50", "50", (14, 15, 16, 17, 18, 19)),
    ("56", "58", (14, 15, 16, 17, 18, 19)), ("63", "63", (16, 17, 18, 19)), ("67", "67", (16, 17, 18, 19)),
    ("2200", "2204", (16, 17, 18, 19)),
)
#: Country codes, with the least and most digits of a whole number.
COUNTRY_CODES = {
    "1": (11, 11), "7": (11, 11), "20": (11, 12), "27": (11, 11), "30": (12, 12), "31": (11, 11), "32": (10, 11),
    "33": (11, 11), "34": (11, 11), "36": (10, 11), "39": (10, 13), "40": (11, 11), "41": (11, 11), "43": (10, 15),
    "44": (11, 12), "45": (10, 10), "46": (10, 12), "47": (10, 10), "48": (11, 11), "49": (10, 15), "51": (10, 11),
    "52": (12, 13), "53": (10, 10), "54": (12, 13), "55": (12, 13), "56": (11, 11), "57": (12, 12), "58": (12, 12),
    "60": (10, 12), "61": (11, 11), "62": (10, 15), "63": (10, 12), "64": (10, 12), "65": (10, 10), "66": (10, 11),
    "81": (11, 12), "82": (10, 12), "84": (11, 12), "86": (12, 13), "90": (12, 12), "91": (12, 12), "92": (11, 12),
    "94": (11, 11), "98": (12, 12), "212": (12, 12), "213": (11, 12), "216": (11, 11), "221": (12, 12),
    "233": (12, 12), "234": (11, 13), "254": (12, 12), "351": (12, 12), "352": (10, 12), "353": (10, 12),
    "354": (10, 10), "358": (10, 13), "359": (11, 12), "370": (11, 11), "371": (11, 11), "372": (10, 11),
    "380": (12, 12), "381": (11, 12), "385": (11, 12), "386": (11, 11), "420": (12, 12), "421": (12, 12),
    "506": (11, 11), "593": (11, 12), "598": (11, 11), "852": (11, 11), "880": (12, 13), "886": (11, 12),
    "961": (10, 11), "962": (11, 12), "966": (11, 12), "971": (11, 12), "972": (11, 12), "995": (12, 12),
}
_SPACE_AND_MARKS = r"[\x20().-]"


def _listed(kind: str, value: Column) -> Column:
    """The gazetteer's vote on a span: 1 if it lists what the span begins or ends with, -1 if it lists none such."""
    if kind == "email":
        host = F.regexp_replace(F.lower(value), r"\x20|[\[(]dot[\])]", ".")
        ending = F.regexp_like(host, F.lit(rf"\.(?:{'|'.join(DOMAINS)}|[a-z]{{2}})$"))
        provider = F.regexp_like(host, F.lit(rf"[@)\].](?:{'|'.join(PROVIDERS)})\.+[a-z]"))
        return F.when(provider, 1).when(ending, 0).otherwise(-1)
    if kind == "ip":
        parts = F.split(value, r"\.")

        def inside(first: str, low: int, high: int) -> Column:
            before = [p for p in first.split(".") if p]
            own = F.get(parts, F.lit(len(before))).try_cast("int").between(low, high)
            for place, part in enumerate(before):
                own = own & (F.get(parts, F.lit(place)).try_cast("int") == int(part))
            return own

        special = inside(*SPECIAL_RANGES[0])
        for row in SPECIAL_RANGES[1:]:
            special = special | inside(*row)
        long = F.contains(value, F.lit(":"))
        public = F.regexp_like(F.lower(value), F.lit("^[23][0-9a-f]{3}:")) & ~F.regexp_like(F.lower(value), F.lit("^2001:0?db8:"))
        return F.when(F.when(long, public).otherwise(~F.coalesce(special, F.lit(True))), 1).otherwise(-1)
    digits = _digits(value)
    if kind == "card":
        found = F.lit(False)
        for first, last, lengths in ISSUERS:
            prefix = F.substring(digits, 1, len(first)).try_cast("int")
            found = found | (prefix.between(int(first), int(last)) & F.char_length(digits).isin(*lengths))
        return F.when(F.coalesce(found, F.lit(False)), 1).otherwise(-1)
    codes = F.create_map(*[F.lit(x) for code, (low, high) in COUNTRY_CODES.items() for x in (code, low * 100 + high)])
    bounds = F.coalesce(*[F.element_at(codes, F.substring(digits, 1, size)) for size in (1, 2, 3)])
    length = F.char_length(digits)
    whole = (length >= F.floor(bounds / 100)) & (length <= bounds % 100)
    local = F.regexp_like(digits, F.lit("^[2-9][0-8][0-9][2-9][0-9]{6}$"))
    return F.when(F.coalesce(F.when(F.startswith(value, F.lit("+")), whole).otherwise(local), F.lit(False)), 1).otherwise(-1)



def _prefix_sums(values: Column) -> Column:
    """Running sums of an array; blocks keep the copying of growing arrays small."""
    empty = F.array().cast("array<bigint>")

    def block(total: Column, k: Column) -> Column:
        return F.aggregate(
            F.slice(values, k * BLOCK + 1, BLOCK),
            F.struct(total.alias("t"), empty.alias("p")),
            lambda s, x: F.struct(
                (s["t"] + x).alias("t"), F.concat(s["p"], F.array(s["t"] + x)).alias("p")
            ),
        )

    def add(state: Column, k: Column) -> Column:
        return bind(
            block(state["t"], k),
            lambda s: F.struct(s["t"].alias("t"), F.concat(state["parts"], F.array(s["p"])).alias("parts")),
        )

    start = F.struct(
        F.lit(0).cast("bigint").alias("t"), F.array().cast("array<array<bigint>>").alias("parts")
    )
    blocks = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int"))
    return F.when(F.size(values) == 0, empty).otherwise(
        F.aggregate(blocks, start, add, lambda s: F.flatten(s["parts"]))
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def part(i: Column) -> Column:
        digit = F.substring(digits, F.char_length(digits) - i, F.lit(1)).cast("int")
        doubled = digit * 2
        return F.when(i % 2 == 0, digit).otherwise(F.when(doubled > 9, doubled - 9).otherwise(doubled))

    places = F.sequence(F.lit(0), F.char_length(digits) - 1)
    return F.aggregate(places, F.lit(0), lambda total, i: total + part(i)) % 10 == 0


def _passes(form: Form, value: Column) -> Column:
    """The check of a form's kind."""
    count = F.char_length(_digits(value))
    if form.kind == "ip":
        if not form.base:
            return F.lit(True)
        return F.regexp_like(value, F.lit(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"))
    if form.kind == "card":
        return F.when(count.between(14, 19), bind(_digits(value), _luhn)).otherwise(F.lit(False))
    if form.kind == "phone":
        return count.between(10, 15)
    return F.lit(True)


def _sign(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _candidate(form: Form, value: Column, before: Column, end: Column) -> Column:
    context = F.right(before, F.lit(CONTEXT_CHARS))
    length = F.char_length(value)
    digits = F.char_length(_digits(value))
    passes = _passes(form, value)
    plain = F.regexp_like(value, F.lit(r"([0-9A-Za-z])\1{5}|0123456|1234567"))
    return F.struct(
        (end - length).alias("start"),
        F.lit(KINDS.index(form.kind)).alias("kind"),
        end.alias("end"),
        (F.lit(form.base) & passes).alias("base"),
        F.array(
            F.when(passes, 1).otherwise(-1),
            F.when(plain, -1).otherwise(1),
            _listed(form.kind, value),
            _sign(F.regexp_like(context, F.lit(CONTEXT[form.kind])), F.regexp_like(context, F.lit(AGAINST))),
        ).alias("votes"),
        F.array(
            F.lit(FORMS.index(form)),
            F.least(F.floor(length / 4).cast("int"), F.lit(12)),
            F.round(digits / length * 4).cast("int"),
            F.least(length - F.char_length(F.regexp_replace(value, _SPACE_AND_MARKS, "")), F.lit(5)),
            _sign(F.regexp_like(context, F.lit(CONTEXT[form.kind])), F.regexp_like(context, F.lit(AGAINST))),
            # What stands right before: a letter or digit speaks of a longer token.
            F.regexp_like(before, F.lit("[0-9A-Za-z]$")).cast("int"),
        ).alias("features"),
    )


def _found(text: Column, form: Form) -> Column:
    """Candidates of one form in a text, in order."""
    empty = F.array().cast(_SPANS)

    def all_of(both: Column) -> Column:
        pieces, values = both["pieces"], both["values"]
        steps = F.transform(
            values, lambda v, i: (F.char_length(v) + F.char_length(F.get(pieces, i))).cast("bigint")
        )
        return bind(
            _prefix_sums(steps),
            lambda ends: F.transform(
                values, lambda v, i: _candidate(form, v, F.get(pieces, i), F.get(ends, i))
            ),
        )

    both = F.struct(
        F.split(text, form.pattern).alias("pieces"),
        F.regexp_extract_all(text, F.lit(form.pattern), F.lit(0)).alias("values"),
    )
    possible = F.contains(text, F.lit("@")) if form.needs == "@" else F.regexp_like(text, F.lit(form.needs))
    return F.when(possible, bind(both, all_of).cast(_SPANS)).otherwise(empty)


def candidates(df: DataFrame, text_column: str = "text") -> DataFrame:
    """Add ``base_spans`` (start, kind, end) in order and ``loose``, the other candidates with votes and features."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    every = with_once(
        df.drop("base_spans", "loose"), _all=F.concat(*[_found(text, form) for form in FORMS])
    )
    spans = F.sort_array(
        F.transform(F.filter("_all", lambda c: c["base"]), lambda c: F.struct(c["start"], c["kind"], c["end"]))
    )
    return (
        every.withColumn("base_spans", spans)
        .withColumn("loose", F.filter("_all", lambda c: ~c["base"]))
        .withColumn("sure", F.transform(F.filter("_all", lambda c: c["base"]), lambda c: F.struct(c["votes"], c["features"])))
        .drop("_all")
    )


@dataclass(frozen=True)
class Model:
    """Reliabilities of the labelers and the classifier's weights; ``bias`` None accepts nothing."""

    reliability: Sequence[dict]
    bias: float | None
    weights: Sequence[dict[int, float]]

    def accepts(self, features: Column) -> Column:
        if self.bias is None:
            return F.lit(False)
        total = F.lit(self.bias)
        for place, table in enumerate(self.weights):
            value = F.get(features, F.lit(place))
            weight = F.lit(0.0)
            for key, log_odds in sorted(table.items()):
                weight = F.when(value == key, log_odds).otherwise(weight)
            total = total + weight
        return total > 0


def fit(found: DataFrame) -> Model:
    """Learn from the votes on all candidates, counted by combination."""
    every = found.select(
        F.explode(
            F.concat("sure", F.transform("loose", lambda c: F.struct(c["votes"], c["features"])))
        ).alias("c")
    )
    rows = [
        (tuple(row["votes"]), tuple(row["features"]), row["n"])
        for row in every.groupBy("c.votes", "c.features").agg(F.count("*").alias("n")).collect()
    ]
    if not rows:
        return Model((), None, ())
    chance, reliability = _reliabilities(rows)
    places = range(len(rows[0][1]))
    yes = sum(n * p for (_, _, n), p in zip(rows, chance, strict=True))
    no = sum(n for _, _, n in rows) - yes
    weights = []
    for place in places:
        seen: dict[int, list[float]] = {}
        for (_, features, n), p in zip(rows, chance, strict=True):
            pair = seen.setdefault(features[place], [0.5, 0.5])
            pair[0] += n * p
            pair[1] += n * (1 - p)
        size = 0.5 * len(seen)
        weights.append({v: math.log(a / (yes + size)) - math.log(b / (no + size)) for v, (a, b) in seen.items()})
    return Model(reliability, math.log((yes + 0.5) / (no + 0.5)), weights)


def _reliabilities(rows: list[tuple]) -> tuple[list[float], list[dict]]:
    """Chance of each row to be personal data and P(vote | class) of each labeler, by expectation-maximisation."""
    labelers = range(len(rows[0][0]))
    chance = [1 / (1 + math.exp(-1.5 * sum(votes))) for votes, _, _ in rows]
    tables: list[dict] = []
    for _ in range(EM_ROUNDS):
        tables = []
        yes = sum(n * p for (_, _, n), p in zip(rows, chance, strict=True)) + 1
        no = sum(n * (1 - p) for (_, _, n), p in zip(rows, chance, strict=True)) + 1
        for k in labelers:
            # A vote for personal data is taken to be better than chance from the start.
            table = {-1: [1 / 6, 1 / 2], 0: [1 / 3, 1 / 3], 1: [1 / 2, 1 / 6]}
            for (votes, _, n), p in zip(rows, chance, strict=True):
                table[votes[k]][0] += n * p
                table[votes[k]][1] += n * (1 - p)
            tables.append({v: (a / yes, b / no) for v, (a, b) in table.items()})
        new = []
        for votes, _, _ in rows:
            odds = math.log(yes / no)
            for k in labelers:
                a, b = tables[k][votes[k]]
                odds += math.log(a) - math.log(b)
            new.append(1 / (1 + math.exp(-max(-50.0, min(50.0, odds)))))
        moved = max(abs(a - b) for a, b in zip(new, chance, strict=True))
        chance = new
        if moved < 1e-6:
            break
    return chance, tables


def spans(found: DataFrame, model: Model) -> DataFrame:
    """Add ``spans``: base spans and accepted loose ones (start, kind, end), in order; drops the candidates."""
    def apart(c: Column) -> Column:
        return ~F.exists("base_spans", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))

    def may_be_added(c: Column) -> Column:
        base_form = F.get(c["features"], F.lit(0)).isin([k for k, form in enumerate(FORMS) if form.base])
        return ~base_form & (F.get(c["votes"], F.lit(0)) == 1)

    added = F.transform(
        F.filter("loose", lambda c: may_be_added(c) & model.accepts(c["features"]) & apart(c)),
        lambda c: F.struct(c["start"], c["kind"], c["end"]),
    )
    every = F.sort_array(F.array_distinct(F.concat("base_spans", added)))
    return with_once(found, spans=every).drop("loose", "sure")


def listing(spans_column: str) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans_column,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def redacted(text: Column, spans_column: str) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans become one."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        return F.when(
            s["start"] >= state["at"],
            F.struct(
                s["end"].alias("at"),
                F.concat(state["parts"], F.array(gap, F.get(names, s["kind"]))).alias("parts"),
            ),
        ).otherwise(F.struct(F.greatest(s["end"], state["at"]).alias("at"), state["parts"].alias("parts")))

    def whole(state: Column) -> Column:
        rest = F.substring(text, (state["at"] + 1).cast("int"), F.char_length(text))
        return F.array_join(F.concat(state["parts"], F.array(rest)), "")

    return F.when(F.size(spans_column) == 0, text).otherwise(F.aggregate(spans_column, start, step, whole))


def find(df: DataFrame, text_column: str = "text", keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Rows with ``base_spans`` and ``spans``; ``keep`` may drop columns, such as the text, before rows are stored.

    Other columns are kept, whatever their names.
    """
    kept = (keep(df) if keep else df).drop("base_spans", "spans").columns
    # Each row as a whole, so that none of its columns is taken for one of these.
    whole = df.select(F.struct(*[F.col(f"`{name}`") for name in kept]).alias("_row"), F.col(text_column).alias("_text"))
    found = stored(candidates(whole, "_text").drop("_text"), "candidates")
    return spans(found, fit(found)).select("_row.*", "base_spans", "spans")


def redact(df: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows with every span of personal data replaced in the text; other columns stay as they are.

    The text is scanned twice, once to learn and once to replace, so that it is not stored.
    """
    rows = df.select(F.struct("*").alias("_row"), F.col(text_column).alias("_text"))
    model = fit(stored(candidates(rows, "_text").select("sure", "loose"), "votes"))
    found = spans(candidates(rows, "_text"), model)
    changed = redacted(F.col("_text"), "spans")
    return found.select(
        *[changed.alias(name) if name == text_column else F.col("_row")[name].alias(name) for name in df.columns]
    )
