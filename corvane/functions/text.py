"""Text functions as Column expressions: normalisation, query terms, keyword scores, masking, parsing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tokens that stand for a missing value when rows are loaded, and when templates are filled.
NULL_TOKENS = ("미입력", "null", "nan")
TEMPLATE_NULL_TOKENS = (*NULL_TOKENS, "none")
#: What a query term is made of, and words that are no query terms.
TERM = "[가-힣一-龥A-Za-z0-9_]+"
STOP_TERMS = ("대해", "대한", "알려", "주세요", "설명", "정리", "핵심", "내용", "무엇", "어떤", "그리고", "the", "a", "an")
TOKEN = r"[\p{L}\p{N}_]+"
#: Kinds of personal data, in the order they are masked.
PII = (
    ("EMAIL", r"(?<![\w.])[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}(?![\w.])"),
    ("PHONE", r"(?<!\d)(?:01[016789]|0[2-6][1-5]?)[- .]?\d{3,4}[- .]?\d{4}(?!\d)"),
    ("RRN", r"(?<!\d)\d{6}[- ]?[1-4]\d{6}(?!\d)"),
    ("ACCOUNT", r"(?<!\d)\d{2,6}[- ]?\d{2,6}[- ]?\d{2,8}(?!\d)"),
)
#: Metadata keys that are dropped.
SENSITIVE_KEYS = ("customer_name", "name", "contact_email", "email", "contact_phone", "phone", "rrn", "resident_number", "account", "account_number")
#: Phrases that mark an attempt to change the instructions; compared without spaces, in lower case.
GUARD = (
    "이전 지시", "지금까지의 규칙", "무시하고", "시스템 프롬프트", "너의 역할을 잊", "관리자 권한", "ignore previous",
    "ignore all prior", "비밀번호", "password", "api key", "apikey", "인증번호", "secret key",
)


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def null_token(c: Column, tokens=NULL_TOKENS) -> Column:
    """Trimmed text, empty where it is null or stands for a missing value."""
    t = F.trim(F.coalesce(c.cast("string"), F.lit("")))
    return F.when(F.lower(t).isin(*tokens), F.lit("")).otherwise(t)


def tokens(c: Column) -> Column:
    """Lower-case word tokens."""
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN), F.lit(0))


def terms(c: Column) -> Column:
    """Distinct query terms of two characters or more that are no stop words, in order, case kept."""
    found = F.regexp_extract_all(c, F.lit(TERM), F.lit(0))
    return F.array_distinct(F.filter(found, lambda x: (F.length(x) >= 2) & ~F.lower(x).isin(*STOP_TERMS)))


def phrases(ts: Column) -> Column:
    """Distinct pairs of neighbouring terms."""
    pairs = F.transform(F.slice(ts, 2, F.size(ts)), lambda x, i: F.concat_ws(" ", F.get(ts, i), x))
    return F.array_distinct(pairs)


def occurrences(text: Column, part: Column) -> Column:
    """How often ``part`` stands in ``text`` without overlaps, case kept."""
    return ((F.length(text) - F.length(F.replace(text, part, F.lit("")))) / F.length(part)).cast("int")


def keyword_score(content: Column, heading: Column, ts: Column, ps: Column) -> Column:
    """12 for a phrase in the content and 18 in the heading; 3 a term in the content, up to 3 times, and 6 in the heading, up to twice."""
    add = lambda xs, f: F.aggregate(xs, F.lit(0), lambda a, x: a + f(x))
    by_phrase = add(ps, lambda p: F.when(F.contains(content, p), 12).otherwise(0) + F.when(F.contains(heading, p), 18).otherwise(0))
    by_term = add(ts, lambda t: 3 * F.least(occurrences(content, t), F.lit(3)) + 6 * F.least(occurrences(heading, t), F.lit(2)))
    return (by_phrase + by_term).cast("int")


def mask_pii(c: Column) -> Column:
    """Text with personal data replaced by the kind's name in brackets, kind after kind."""
    for kind, pattern in PII:
        c = F.regexp_replace(c, "(?U)" + pattern, f"[{kind}]")
    return c


def pii_kinds(c: Column) -> Column:
    """Kinds found, each looked for in the text that the kinds before have left."""
    found = []
    for kind, pattern in PII:
        found.append(F.when(F.regexp_like(c, F.lit("(?U)" + pattern)), F.lit(kind)))
        c = F.regexp_replace(c, "(?U)" + pattern, f"[{kind}]")
    return F.array_compact(F.array(*found))


def guard_normalize(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, r"\s+", ""))


def is_injection(c: Column) -> Column:
    flat = guard_normalize(c)
    found = [F.contains(flat, F.lit("".join(g.split()))) for g in GUARD]
    return reduce(Column.__or__, found)


#: Fixed value: a numbered or lettered heading.
NUMBERED = r"^\s*(?:\d+(?:\.\d+)*|[IVXLC]+|[A-Z])(?:[.\)]|\s)\s*\S+"


def sparse_text(meta: Column, content: Column) -> Column:
    """What lexical routes index of a document with metadata: headings, title and source in a line before the content."""
    keys = ("H1", "H2", "H3", "H4", "title", "source")  # fixed values
    line = F.concat_ws(" ", *[F.coalesce(F.try_element_at(meta, F.lit(k)), F.lit("")) for k in keys])
    return F.regexp_replace(F.concat(line, F.lit("\n"), F.coalesce(content, F.lit(""))), r"(?U)^\s+|\s+$", "")


def heading_level(line: Column) -> Column:
    """Level 1 to 6 of a numbered heading of up to 160 characters: dots in its first token plus one; null for other lines."""
    line = F.trim(F.regexp_replace(line, r"\s+", " "))
    first = F.element_at(F.split(line, " "), 1)
    dots = F.length(first) - F.length(F.replace(first, F.lit("."), F.lit("")))
    return F.when((F.length(line) <= 160) & F.regexp_like(line, F.lit("(?i)" + NUMBERED)), F.least(dots + 1, F.lit(6)).cast("int"))


def normal_id(c: Column) -> Column:
    """Trimmed id without a trailing ``.0``; null becomes empty."""
    return F.regexp_replace(F.trim(F.coalesce(c.cast("string"), F.lit(""))), r"^(\d+)\.0$", "$1")


def stable_json(m: Column) -> Column:
    """A map as JSON with sorted keys and nulls kept."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m))), {"ignoreNullFields": "false"})


def strip_nul(c: Column) -> Column:
    return F.translate(c, "\x00", "")


def strip_nul_map(m: Column) -> tuple[Column, Column]:
    """(a map without NUL characters in keys and values, how many there were)."""
    clean = F.map_from_entries(F.transform(F.map_entries(m), lambda e: F.struct(strip_nul(e["key"]).alias("key"), strip_nul(e["value"]).alias("value"))))
    nuls = lambda c: F.coalesce(F.length(c) - F.length(strip_nul(c)), F.lit(0))
    return clean, F.aggregate(F.map_entries(m), F.lit(0), lambda a, e: a + nuls(e["key"]) + nuls(e["value"]))


def clamped(c: Column, least: int, most: int) -> Column:
    """A batch size as text, no less and no more than allowed; the least where it is no number."""
    return F.least(F.greatest(F.coalesce(c.try_cast("int"), F.lit(least)), F.lit(least)), F.lit(most))


def regex_int(c: Column, default: Column | None = None, signed: bool = True) -> Column:
    """The text as int where it is a whole number, else ``default``."""
    ok = F.regexp_like(F.coalesce(c, F.lit("")), F.lit("^-?[0-9]+$" if signed else "^[0-9]+$"))
    return F.when(ok, c.try_cast("int")).otherwise(default if default is not None else F.lit(None).cast("int"))


def json_object_text(c: Column) -> Column:
    """The whole text if it is a JSON object, else its outermost ``{...}``, if that is one."""
    is_object = lambda x: F.try_parse_json(x).isNotNull() & F.regexp_like(x, F.lit(r"(?s)^\s*\{.*\}\s*$"))
    inner = F.regexp_extract(c, r"(?s)\{.*\}", 0)
    return F.when(is_object(c), F.regexp_replace(c, r"^\s+|\s+$", "")).when(is_object(inner), inner)


def llm_score(c: Column) -> Column:
    """The number in a model's answer, 0 if there is none."""
    return F.coalesce(F.regexp_replace(c, "[^0-9.]", "").try_cast("double"), F.lit(0.0))


def verdicts(c: Column, expected: Column) -> Column:
    """0/1 verdicts of an answer; null where their number is not the expected one."""
    found = F.transform(F.regexp_extract_all(c, F.lit(r"(?<!\d)[01](?!\d)"), F.lit(0)), lambda x: x.cast("int"))
    return F.when(F.size(found) == expected, found)


def listed_order(c: Column, n: Column) -> Column:
    """An answer like ``3,1,2`` as valid distinct places from 0, then the places it leaves out."""
    all_places = F.transform(F.sequence(F.lit(1), n), lambda x: x - 1)
    named = F.transform(F.split(c, ","), lambda x: F.when(F.regexp_like(F.trim(x), F.lit("^[0-9]+$")), F.trim(x).try_cast("int") - 1))
    valid = F.array_distinct(F.filter(named, lambda x: x.isNotNull() & (x >= 0) & (x < n)))
    return F.concat(valid, F.array_except(all_places, valid))


def model_lines(c: Column, n: int) -> Column:
    """Distinct non-empty lines without bullets or numbers in front, the first ``n``."""
    lines = F.transform(F.split(c, "\n"), lambda x: F.trim(F.regexp_replace(x, r"^[\s\-*•\d.)]+", "")))
    return F.slice(F.array_distinct(F.filter(lines, lambda x: x != "")), 1, n)


def elapsed(seconds: Column) -> Column:
    """``5.0s``, ``2m 5.0s`` or ``1h 2m 5.0s``."""
    h, m, s = F.floor(seconds / 3600).cast("int"), F.floor(seconds % 3600 / 60).cast("int"), seconds % 60
    return F.when(h > 0, F.format_string("%dh %dm %.1fs", h, m, s)).when(m > 0, F.format_string("%dm %.1fs", m, s)).otherwise(F.format_string("%.1fs", s))
