"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Native expressions only. A pattern's matches come from ``regexp_extract_all`` and their places from
the pieces that ``split`` leaves between them: both scan left to right without overlap, so the
lengths add up to code-point offsets.

Spans of the four base kinds (email, ip, card, phone) are always reported. Two kinds are added when
their score reaches ``THRESHOLD``: ``iban`` (needs its mod-97 checksum) and ``local_phone`` (a number
without country code, needs a context word nearby and no overlap with a base span).

Defined cases: a null text counts as empty and has no spans; a very long text is scanned whole, in time
linear in its length; repeated rows keep a row each; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import whole

THRESHOLD = 0.5
NEAR = 40
"""Characters before a span, and half as many after it, in which context words count."""

SPAN = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


@dataclass(frozen=True)
class Kind:
    """guard: true where the pattern can match at all; score: without checksum and context."""

    name: str
    pattern: str
    guard: str
    score: float
    context: str


# The possessive quantifiers and \G keep each scan linear; they match what the plain patterns match.
EMAIL = Kind(
    "email",
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "@", 0.8, "e-?mail|mail|contact|write|kontakt|contacto|courriel|correo",
)
IP = Kind(
    "ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]",
    0.6, r"\bip\b|address|server|host|adresse|login",
)
CARD = Kind(
    "card", r"[0-9](?:[ -]?[0-9])++", r"[0-9](?:[ -]?[0-9]){15}",
    0.3, "card|visa|master|credit|karte|carte|tarjeta|payment",
)
PHONE = Kind(
    "phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]",
    0.6, "phone|tel|call|fax|mobile|handy|appel|llam",
)
IBAN = Kind(
    "iban",
    r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    r"[A-Z]{2}[0-9]{2}", 0.2, "iban|account|bank|konto|compte|cuenta",
)
LOCAL_PHONE = Kind(
    "local_phone",
    r"(?<![0-9A-Za-z+(.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    r"[0-9]{3}[ .-][0-9]{4}", 0.3, PHONE.context,
)
CHECKED, CONTEXT = 0.4, 0.2


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """True where a string of digits passes the Luhn check."""
    value = F.transform(F.split(F.reverse(number), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2))
    total = F.aggregate(value, F.lit(0), lambda s, v: s + F.when(v > 9, v - 9).otherwise(v))
    return total % 10 == 0


def mod97(account: Column) -> Column:
    """True where an account number, blanks removed, leaves 1 on division by 97."""
    moved = F.concat(F.substring(account, 5, 1000), F.substring(account, 1, 4))
    code = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    step = lambda r, c: (r * F.when(c.between("0", "9"), 10).otherwise(100) + code(c)) % 97
    return F.aggregate(F.split(moved, ""), F.lit(0), step) == 1


def _small_part(part: Column) -> Column:
    short = F.regexp_replace(part, "^0+(?=[0-9])", "")
    return (F.length(short) < 4) & (F.lpad(short, 3, "0") <= "255")


def _valid(kind: Kind, match: Column) -> Column:
    """The checksum or range a match must pass."""
    if kind is IP:
        return F.forall(F.split(match, r"\."), _small_part)
    if kind is CARD:
        number = digits(match)
        return F.when(F.length(number).between(16, 19), luhn(number)).otherwise(F.lit(False))
    if kind is PHONE:
        return F.length(digits(match)).between(8, 15)
    if kind is IBAN:
        account = F.replace(match, F.lit(" "), F.lit(""))
        return F.when(F.length(account).between(15, 34), mod97(account)).otherwise(F.lit(False))
    return F.lit(True)


def _confirmed(kind: Kind, match: Column) -> Column:
    """What of a match passes, null if nothing does: all of it, or of an IBAN the most groups that do.

    The last groups of an IBAN's pattern may be a word in capitals behind the number.
    """
    if kind is not IBAN:
        return F.when(_valid(kind, match), match)
    groups = F.split(match, " ")
    ends = F.transform(F.sequence(F.lit(1), F.size(groups)), lambda n: F.array_join(F.slice(groups, 1, n), " "))
    return F.get(F.reverse(F.filter(ends, lambda m: _valid(kind, m))), F.lit(0))


def _scanned(text: Column, kind: Kind) -> list[Column]:
    """The matches of the pattern, and the pieces between them."""
    guard = F.contains(text, F.lit(kind.guard)) if len(kind.guard) == 1 else text.rlike(kind.guard)
    none = F.array().cast("array<string>")
    return [
        F.when(guard, F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))).otherwise(none).alias(f"{kind.name}_matches"),
        F.when(guard, F.split(text, kind.pattern, -1)).otherwise(none).alias(f"{kind.name}_pieces"),
    ]


def _proposed(kind: Kind) -> Column:
    """(match, gap before it, characters before, characters after) of every match."""
    pieces = F.col(f"{kind.name}_pieces")
    return F.transform(
        f"{kind.name}_matches",
        lambda m, i: F.struct(
            m.alias("match"),
            F.length(F.get(pieces, i)).alias("gap"),
            F.lower(F.right(F.get(pieces, i), F.lit(NEAR))).alias("before"),
            F.lower(F.left(F.get(pieces, i + 1), F.lit(NEAR // 2))).alias("after"),
        ),
    )


def _placed(proposed: Column, kind: Kind) -> Column:
    """Spans of one kind with their scores, failing matches dropped."""
    # Ends of the matches before each one, summed over numbers alone: the state is copied at every step.
    advance = F.transform(proposed, lambda p: (p["gap"] + F.length(p["match"])).cast("bigint"))
    zero = F.array(F.lit(0).cast("bigint"))
    ends = F.aggregate(advance, zero, lambda s, a: F.concat(s, F.array(F.element_at(s, -1) + a)))
    met = F.zip_with(
        proposed, ends,
        lambda p, e: F.struct(p["match"].alias("match"), (e + p["gap"]).alias("start"), p["before"].alias("before"), p["after"].alias("after")),
    )
    # There is one end more than matches.
    found = F.transform(met, lambda p: p.withField("match", F.when(p["match"].isNotNull(), _confirmed(kind, p["match"]))))
    checked = kind in (IP, CARD, IBAN)

    def scored(p):
        context = p["before"].rlike(kind.context) | p["after"].rlike(kind.context)
        score = F.lit(kind.score + CHECKED * checked) + F.when(context, F.lit(CONTEXT)).otherwise(F.lit(0.0))
        return F.struct(
            F.lit(kind.name).alias("kind"),
            p["start"].alias("start"),
            (p["start"] + F.length(p["match"])).cast("bigint").alias("end"),
            F.least(score, F.lit(1.0)).alias("score"),
        )

    return F.transform(F.filter(found, lambda p: p["match"].isNotNull()), scored)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and the arrays of spans of each kind; offsets in code points, end exclusive."""
    base, added = (EMAIL, IP, CARD, PHONE), (IBAN, LOCAL_PHONE)
    texts = docs.select("doc_id", whole(F.col("text")).alias("_text"))
    # Matches and pieces are columns of their own: inside a lambda they would be computed for each match.
    scanned = texts.select("doc_id", *[c for k in base + added for c in _scanned(F.col("_text"), k)])
    placed = scanned.select("doc_id", *[_placed(_proposed(k), k).alias(k.name) for k in base + added])
    sure = F.concat(*[F.col(k.name) for k in base])
    free = lambda s: ~F.exists(sure, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    kept = lambda k: F.filter(F.col(k.name), lambda s: (s["score"] >= THRESHOLD) & free(s))
    return placed.select("doc_id", *[k.name for k in base], *[kept(k).alias(k.name) for k in added])


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, their sha256, and all spans as text."""
    base = ("email", "ip", "card", "phone")
    listed = F.concat(*[F.col(k) for k in base])
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(_listed(listed), 256).alias("base_sha256"),
        _listed(F.concat(*[F.col(k) for k in (*base, "iban", "local_phone")])).alias("spans"),
    )
