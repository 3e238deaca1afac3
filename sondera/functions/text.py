"""Text functions as Column expressions; all stay inside the JVM.

White space and word characters are spelled out, as regular expression engines differ on
them: SPACE is every character that Unicode-aware stripping removes, WORD is letters,
numbers and the underscore.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

#: The characters of SPACE.
SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

# Advertising phrases removed from notes.
AD_PATTERNS = [
    "对于想求职.*?欢迎后台联系",
    "点赞.*?收藏.*?关注",
    "加群.*?私信",
    "扫码.*?关注",
    "更多面试题.*?关注",
    "🐵公式解析失败.*",
]

# Punctuation rewritten after the width conversion.
PUNCTUATION = [("。", ". "), ("【", " ["), ("】", "] "), ("「", ' "'), ("」", '" '), ("『", " '"), ("』", "' ")]

# Term rewrites, applied one after another in this order.
TERMS = [
    ("batch norm", "BatchNorm"),
    ("batch normalization", "BatchNorm"),
    ("layer norm", "LayerNorm"),
    ("layer normalization", "LayerNorm"),
    ("rms norm", "RMSNorm"),
    ("attention机制", "Attention"),
    ("注意力机制", "Attention"),
    ("自注意力", "Self-Attention"),
    ("多头注意力", "Multi-Head Attention"),
]

# List markers in table cells.
CHINESE_MARKER = "[一二三四五六七八九十]+[：:.]"
DIGIT_MARKER = r"\p{Nd}+[.、）]"

FULL_WIDTH = "　" + "".join(map(chr, range(0xFF01, 0xFF5F)))
HALF_WIDTH = " " + "".join(map(chr, range(0x21, 0x7F)))


def _text(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def strip(c: Column | str) -> Column:
    """Without white space of any kind at either end."""
    return F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(SPACES))


def blank(c: Column | str) -> Column:
    return strip(_text(c)) == ""


def extract(c: Column | str, pattern: str, group: int = 1) -> Column:
    """A group of the first match, or null without a match."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def strip_lines(c: Column) -> Column:
    return F.array_join(F.transform(F.split(c, "\n", -1), strip), "\n")


def clean_text(c: Column | str) -> Column:
    """Tags and advertising go, runs of 3 or more newlines become 2, then every line and the whole are stripped; null is ''."""
    t = F.regexp_replace(_text(c), "<[^>]+>", "")
    t = reduce(lambda x, p: F.regexp_replace(x, f"(?iud){p}", ""), AD_PATTERNS, t)
    return strip(strip_lines(F.regexp_replace(t, "\n{3,}", "\n\n")))


def _listed(t: Column, marker: str) -> Column:
    """One line per marker with its stripped body; what stands before the first marker goes."""
    parts = F.split(F.regexp_replace(t, f"({marker})", "\u0001$1"), "\u0001", -1)
    line = lambda p: F.concat(F.regexp_extract(p, rf"\A{marker}", 0), strip(F.regexp_replace(p, rf"\A{marker}", "")))
    return F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), line), "\n")


def clean_csv_text(c: Column | str) -> Column:
    """White space collapsed, two wide marks narrowed, numbered items on lines of their own."""
    t = F.regexp_replace(_text(c), f"{SPACE}+", " ")
    t = F.replace(F.replace(t, F.lit("；"), F.lit(";")), F.lit("："), F.lit(":"))
    chosen = F.when(t.rlike(CHINESE_MARKER), _listed(t, CHINESE_MARKER)).when(t.rlike(DIGIT_MARKER), _listed(t, DIGIT_MARKER)).otherwise(t)
    return strip(chosen)


def narrow(c: Column) -> Column:
    """Full-width forms to their ASCII counterparts, white space of any kind to spaces."""
    return F.translate(c, FULL_WIDTH + SPACES, HALF_WIDTH + " " * len(SPACES))


def punctuate(c: Column) -> Column:
    """Punctuation rewritten and runs of spaces collapsed; narrow has made all white space spaces."""
    t = reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), PUNCTUATION, c)
    return F.regexp_replace(t, " {2,}", " ")


def term_mark(term: str) -> str:
    """A part without which a term cannot occur: its longest run of Chinese characters, else its last word."""
    return max(re.findall("[\u4e00-\u9fff]+", term), key=len, default=term[max(term.rfind(" "), 0) :])


def map_terms(c: Column, terms: list[tuple[str, str]] | None = None) -> Column:
    """Case-insensitive literal rewrites in order; an earlier one can keep a later one from matching.

    Texts without any mark of a term, which are most, are read once and stay as they are.
    """
    terms = TERMS if terms is None else terms
    marks = {term_mark(k) for k, _ in terms}
    marks = [m for m in sorted(marks) if not any(o != m and o in m for o in marks)]
    if not marks:
        return c
    rewritten = lambda x: reduce(lambda y, p: F.regexp_replace(y, rf"(?iu)\Q{p[0]}\E", p[1].replace("\\", "\\\\").replace("$", "\\$")), terms, x)
    marked = "(?iu)" + "|".join(rf"\Q{m}\E" for m in marks)
    return F.transform(F.array(c), lambda x: F.when(x.rlike(marked), rewritten(x)).otherwise(x))[0]  # a lambda, so that the text is made once


def normalize(c: Column | str, terms: list[tuple[str, str]] | None = None) -> Column:
    """Width, punctuation, white space and terms; null is ''."""
    return strip(map_terms(punctuate(narrow(_text(c))), terms))


def compare_key(c: Column | str) -> Column:
    """Lower case, letters, numbers and underscores only."""
    return F.regexp_replace(F.lower(_text(c)), r"[^\p{L}\p{N}_]+", "")


def exact_key(c: Column | str) -> Column:
    return F.lower(strip(_text(c)))


def sentences(c: Column | str) -> Column:
    """Cut after sentence marks; parts are stripped and empty ones go."""
    parts = F.split(_text(c), rf"(?<=[。！？.!?]){SPACE}*", -1)
    return F.filter(F.transform(parts, strip), lambda x: x != "")


def paragraphs(c: Column | str) -> Column:
    return F.filter(F.transform(F.split(_text(c), "\n\n", -1), strip), lambda x: x != "")


def tags(c: Column | str) -> Column:
    """'#a #b' to [a, b]."""
    return F.filter(F.transform(F.split(_text(c), "#", -1), strip), lambda x: x != "")


def sheet_safe(c: Column | str) -> Column:
    """Without the control characters that spreadsheets reject."""
    return F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")


def sheet_name(name: str, taken) -> str:
    """A sheet name that is not taken: marks that sheets may not have become underscores, and a number follows if needed."""
    plain = "".join("_" if c in "[]:*?/\\" else c for c in name)[:31] or "_"
    n, out = 1, plain
    while out in taken:
        n += 1
        out = f"{plain[:27]} ({n})"
    return out


def halves(c: Column | str) -> Column:
    """A text cut in two for a retry: at the middle paragraph, else at the last newline before the middle, else in the middle."""
    c = F.col(c) if isinstance(c, str) else c
    parts = paragraphs(c)
    n, mid = F.size(parts), F.floor(F.length(c) / 2).cast("int")
    head = F.substring(c, F.lit(1), mid)
    line = mid - F.instr(F.reverse(head), "\n")
    cut = F.when(F.contains(head, F.lit("\n")) & (line > 0), line).otherwise(mid)
    by_paragraph = F.array(F.array_join(F.slice(parts, 1, F.floor(n / 2).cast("int")), "\n\n"), F.array_join(F.slice(parts, F.floor(n / 2).cast("int") + 1, n), "\n\n"))
    by_place = F.array(strip(F.substring(c, F.lit(1), cut)), strip(F.substring(c, cut + 1, F.length(c))))
    both = F.when(n >= 2, by_paragraph).otherwise(by_place)
    return F.when(F.exists(both, lambda x: x == ""), F.array(c)).otherwise(both)


def percent(c: Column, digits: int = 2) -> Column:
    return F.format_string(f"%.{digits}f%%", c * 100)


def tier(count: Column | str) -> Column:
    """Frequency tier 3, 2, 1 or 0 for counts from 20, 10, 5 and below."""
    c = F.col(count) if isinstance(count, str) else count
    return F.when(c >= 20, 3).when(c >= 10, 2).when(c >= 5, 1).otherwise(0)


def tier_icon(count: Column | str) -> Column:
    return F.repeat(F.lit("🔥"), tier(count))
