"""Personal data by pattern, checksum and context, in DataFrame expressions only.

Patterns propose spans; validators confirm them (Luhn for card numbers,
mod-97 for IBANs, value and digit-count rules for the rest); nearby context
words raise the score, and the weak kind ``ssn`` is reported only with such a
word beside it. Everything is one projection over the text column: nothing is
shuffled, and texts without the characters a pattern needs skip its work.

Positions are code points, end exclusive. They come from splitting the text at
the pattern: the lengths of the pieces and of the matches add up. Patterns are
written without backtracking (possessive) where the leftmost longest match
allows it, so long digit runs or long words cost linear time, and a text's
matches are walked in time close to linear in their number.

Defined results: null text counts as empty and has no spans; every row is
judged on its own; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTEXT_CHARS = 40
CONTEXT_BONUS = 0.25
REPORT_SCORE = 0.5
BLOCK = 128             # matches walked with one growing array
AHEAD = 2 * CONTEXT_CHARS // 4 + 1      # pieces that can lie within the context behind a match (of 4 characters at least)

_DIGITS = "regexp_replace({m}, '[^0-9]', '')"
_LUHN = (f"aggregate(sequence(1, length({_DIGITS})), 0, (s, i) -> s + "
         f"cast(substr({_DIGITS}, length({_DIGITS}) - i + 1, 1) as int) * (1 + (1 - i % 2)) - "
         f"if(i % 2 = 0 and substr({_DIGITS}, length({_DIGITS}) - i + 1, 1) > '4', 9, 0)) % 10 = 0")
_CARD = f"case when length({_DIGITS}) between 14 and 19 then {_LUHN} else false end"
_IP = "forall(split({m}, '[.]'), p -> coalesce(try_cast(p as int), 256) <= 255)"
_PHONE = f"length({_DIGITS}) between 10 and 15"
_COMPACT = "replace({m}, ' ', '')"
_MOD97 = (f"aggregate(split(concat(substr({_COMPACT}, 5), substr({_COMPACT}, 1, 4)), ''), 0, (r, c) -> "
          "if(c = '', r, if(c between '0' and '9', (r * 10 + cast(c as int)) % 97, (r * 100 + ascii(c) - 55) % 97))) = 1")


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: when to look, what to propose, how to confirm, how sure to be."""

    name: str
    needs: str       # cheap condition on the text t
    pattern: str
    valid: str       # condition on the match {m}
    score: float
    context: str     # words that make it likelier
    base: bool = True


KINDS = [
    Kind("email", "contains(t, '@')",
         r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "true", 0.9, "mail|contact|write"),
    Kind("ip", r"t rlike r'[0-9]\.[0-9]+\.[0-9]+\.[0-9]'",
         r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _IP, 0.6, "address|host|server|login"),
    Kind("card", r"t rlike r'[0-9](?:[\x20-]?[0-9]){13}'",
         r"[0-9](?:[\x20-]?+[0-9])++", _CARD, 0.8, "card|credit|payment|pay"),
    Kind("phone", r"t rlike r'\+[0-9]'", r"\+[0-9][\x20().0-9-]+[0-9]", _PHONE, 0.6, "phone|call|tel|mobile"),
    Kind("iban", r"t rlike r'[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}'",
         r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         _MOD97, 0.9, "iban|account|bank", base=False),
    Kind("ssn", r"t rlike r'[0-9]{3}-[0-9]{2}-[0-9]{4}'",
         r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
         "true", 0.4, "social security|ssn", base=False),
]

_SPAN = "struct<b:int,k:int,e:int,kind:string,score:double>"


def _spans(i: int, k: Kind) -> str:
    """SQL for the array of confirmed spans of one kind in t.

    The pieces between the matches and the matches are z; they are walked
    once, left to right, in blocks of ``BLOCK``. A first walk gives each block
    its position and the text's last ``CONTEXT_CHARS`` before it. The context
    of a match comes from these, the piece before it and the few pieces and
    matches after it, so that nothing is looked up in t again; spans are
    gathered by block, so that no growing array is copied match by match.
    """
    x = "element_at(z, j)"
    before = f"right(concat(acc.tail, {x}.`0`), {CONTEXT_CHARS})"
    b, e = f"acc.p + length({x}.`0`)", f"acc.p + length({x}.`0`) + length({x}.`1`)"
    ahead = (f"array_join(transform(slice(z, j + 1, {AHEAD}), n -> concat(left(n.`0`, {2 * CONTEXT_CHARS}), "
             f"left(coalesce(n.`1`, ''), {2 * CONTEXT_CHARS}))), '')")
    # near the text's begin, what is missing before the match is added behind it
    near = f"lower(concat({before}, {x}.`1`, left({ahead}, {2 * CONTEXT_CHARS} - length({before})))) rlike '{k.context}'"
    score = f"least(1.0D, {k.score}D + if({near}, {CONTEXT_BONUS}D, 0D))"
    valid = k.valid.replace("{m}", f"{x}.`1`")
    span = f"named_struct('b', {b}, 'k', {i}, 'e', {e}, 'kind', '{k.name}', 'score', {score})"
    block = f"slice(z, n * {BLOCK} + 1, {BLOCK})"
    begins = (f"aggregate(sequence(0, (size(z) - 1) div {BLOCK}), "
              f"named_struct('p', 0, 'tail', '', 'a', cast(array() as array<struct<n:int,p:int,tail:string>>)), "
              f"(acc, n) -> named_struct("
              f"'p', acc.p + aggregate({block}, 0, (l, y) -> l + length(y.`0`) + coalesce(length(y.`1`), 0)), "
              f"'tail', right(concat(acc.tail, array_join(transform({block}, y -> concat(y.`0`, coalesce(y.`1`, ''))), '')), {CONTEXT_CHARS}), "
              f"'a', concat(acc.a, array(named_struct('n', cast(n as int), 'p', acc.p, 'tail', acc.tail)))), acc -> acc.a)")
    walk = (f"flatten(transform({begins}, s -> aggregate(sequence(s.n * {BLOCK} + 1, least((s.n + 1) * {BLOCK}, size(z))), "
            f"named_struct('p', s.p, 'tail', s.tail, 'a', cast(array() as array<{_SPAN}>)), "
            f"(acc, j) -> named_struct('p', acc.p + length({x}.`0`) + coalesce(length({x}.`1`), 0), "
            f"'tail', right(concat({before}, coalesce({x}.`1`, '')), {CONTEXT_CHARS}), "
            f"'a', case when {x}.`1` is null then acc.a when {valid} then concat(acc.a, array({span})) else acc.a end), "
            "acc -> acc.a)))")
    if k.score < REPORT_SCORE:      # too weak without a context word
        walk = f"filter({walk}, y -> y.score >= {REPORT_SCORE})"
    pieces = f"arrays_zip(split(t, r'{k.pattern}', -1), regexp_extract_all(t, r'{k.pattern}', 0))"
    # a one-element array binds z, so that the text is split once
    return f"case when {k.needs} then transform(array({pieces}), z -> {walk})[0] else cast(array() as array<{_SPAN}>) end"


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and ``found``, the confirmed spans by start and kind, with scores."""
    t = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.expr(f"coalesce(`{text_col}`, '')").alias("t"))
    each = [F.expr(_spans(i, k)) for i, k in enumerate(KINDS)]
    return t.select("doc_id", F.array_sort(F.concat(*each)).alias("found"))


def digest(found: DataFrame) -> DataFrame:
    """Counts per kind, the hash of the base spans and the text of all spans."""
    def text(spans: str) -> str:
        return f"concat_ws(',', transform({spans}, x -> concat(x.kind, ':', x.b, ':', x.e)))"
    base = sum(k.base for k in KINDS)
    count = [F.expr(f"cast(size(filter(found, x -> x.k = {i})) as bigint)").alias(f"n_{k.name}")
             for i, k in enumerate(KINDS)]
    return found.select("doc_id", *count,
                        F.expr(f"sha2({text(f'filter(found, x -> x.k < {base})')}, 256)").alias("base_sha256"),
                        F.expr(text("found")).alias("spans"),
                        F.expr("coalesce(array_max(transform(found, x -> x.score)), 0D)").alias("max_score"))
