"""Text expressions that agree with Python's str methods where Java's differ.

Java's \\s lacks U+3000 and others unless (?U) is set, and U+001C-U+001F even then.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Line ends of str.splitlines().
LINE_END = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x85\\u2028\\u2029]"
OTHER_ENDS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
#: Characters that str.isspace() accepts, as a class body.
SPACE = r"\s\x1c-\x1f\x85"
#: Runs of those of ASCII, one by one: a set of bits, where ranges and (?U) are chains of questions.
ASCII_SPACE = r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f ]+"
#: The same, one by one.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_FULL = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
_HALF = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F))


def has_other_ends(c: Column) -> Column:
    """Whether a line end but the line feed is there, which texts seldom have. Searches of bytes: a pattern
    would have the text decoded, and asks more of each character than all of these."""
    return functools.reduce(lambda a, b: a | b, (F.contains(c, F.lit(e)) for e in OTHER_ENDS))


def without_last_empty(parts: Column) -> Column:
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def split_lines(c: Column) -> Column:
    """str.splitlines(): no empty line after a final line end, none for an empty text."""
    parts = lambda x: F.when(has_other_ends(x), F.split(x, LINE_END, -1)).otherwise(F.split(x, "\n", -1))
    return let(c, lambda x: let(parts(x), without_last_empty))  # bound, so that it is made once, not for each end looked for, and split once


def strip(c: Column) -> Column:
    """str.strip()."""
    return F.btrim(c, F.lit(BLANKS))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(BLANKS))


def is_ascii(c: Column) -> Column:
    """By its length."""
    return F.octet_length(c) == F.char_length(c)


def half_width(c: Column) -> Column:
    """Full-width forms U+FF01-U+FF5E as ASCII, which has none."""
    return F.when(is_ascii(c), c).otherwise(F.translate(c, _FULL, _HALF))


def compact(c: Column) -> Column:
    """Without white space, full-width folded: the form in which answers are compared."""
    return F.regexp_replace(half_width(c), f"(?U)[{SPACE}]+", "")


def sha16(c: Column) -> Column:
    return F.substring(F.sha2(c, 256), 1, 16)


def numbered_line(no: Column, text: Column) -> Column:
    """A line as a prompt shows it."""
    return F.format_string("[L%04d] %s", no, text)


def find_all(c: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), group)


def count_of(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern)).cast("long")


def one_of(values: Column) -> Column:
    """The only distinct value of an array, else null."""
    seen = F.array_distinct(values)
    return F.when(F.size(seen) == 1, seen[0])


def tags(flags: dict[str, Column]) -> Column:
    """Names of the flags that are true, in their order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in flags.items()]))


def first_match(rules: Sequence[tuple[str, Column]], otherwise: str | None = None) -> Column:
    """Label of the first rule that holds; a null condition does not hold."""
    out = F.lit(otherwise)
    for label, holds in reversed(rules):
        out = F.when(holds, F.lit(label)).otherwise(out)
    return out


def best_score(scores: dict[str, Column], least: int, otherwise: str | None = None) -> Column:
    """Name of the highest score, the first named among equals, if it is ``least`` or more."""
    ranked = [F.struct(c.cast("long").alias("score"), F.lit(-i).alias("rank"), F.lit(n).alias("name")) for i, (n, c) in enumerate(scores.items())]
    best = F.array_max(F.array(*ranked))
    return F.when(best["score"] >= least, best["name"]).otherwise(F.lit(otherwise))


def image_refs(c: Column) -> Column:
    """Image references, HTML ones first: the src of img tags and the targets of ![...](...)."""
    return F.concat(find_all(c, r"<img[^>]*?src=[\"']([^\"']+)[\"']", 1), find_all(c, r"!\[[^\]]*\]\(([^)\s]+)[^)]*\)", 1))


def ref_kind(ref: Column) -> Column:
    return F.when(ref.rlike("^(?i)https?://"), "remote").when(ref.rlike("^(?i)data:"), "embedded").otherwise("local")


def safe_path(ref: Column) -> Column:
    """Relative, without drive and without parent steps."""
    return ~ref.rlike(r"^[/\\]|^[A-Za-z]:|(^|[/\\])\.\.([/\\]|$)") & (F.length(ref) > 0)


def redact(c: Column) -> Column:
    """Mask what looks like an access key."""
    return F.regexp_replace(c, r"(?i)\b(sk-|bearer\s+)[A-Za-z0-9._-]{8,}", "$1***")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, though it stands in lambdas of ``body``: there a
    plain expression would be computed for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with columns that the optimizer does not move into the lambdas that use them."""
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))))
