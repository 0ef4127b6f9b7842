"""Field extraction from stored HTML (X1-X3, X6) as regex expressions.

Pages are parsed with JVM regex functions, so extraction runs inside the
scan's codegen stage. Script, style and comment blocks are removed first,
because their text can contain markup-like strings (``"</p>"``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobstar.functions.text import as_col

NOISE_BLOCKS = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
# Explicit whitespace class: Java's and RE2's \s differ on \x0B.
SPACES = r"[\t\n\x0B\f\r ]+"

# ---- fixed values: named entities decoded in text (&amp; last) ----------
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
            ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]
# -------------------------------------------------------------------------


def strip_noise(html) -> Column:
    return F.regexp_replace(as_col(html), NOISE_BLOCKS, " ")


def decode_entities(c) -> Column:
    out = as_col(c)
    for ent, ch in ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return out


def html_text(fragment) -> Column:
    """Markup -> visible text: tags dropped, entities decoded, whitespace
    squeezed and trimmed (the "element text" of a browser)."""
    no_tags = F.regexp_replace(as_col(fragment), r"<[^>]*>", " ")
    return F.trim(F.regexp_replace(decode_entities(no_tags), SPACES, " "))


def element_text(html, tag: str, attrs: str = "") -> Column:
    """Text of the first ``<tag attrs...>`` element; missing -> null."""
    inner = F.regexp_extract(as_col(html), rf"(?is)<{tag}\b{attrs}[^>]*>(.*?)</{tag}>", 1)
    return F.nullif(html_text(inner), F.lit(""))


def attr_values(html, tag: str, attr: str) -> Column:
    """Values of ``attr`` on every ``<tag>`` in document order."""
    return F.regexp_extract_all(as_col(html), F.lit(rf'(?is)<{tag}\b[^>]*\b{attr}="([^"]*)"'), F.lit(1))


def elements_text(html, tag: str) -> Column:
    """Text of every ``<tag>...</tag>`` element in document order."""
    inner = F.regexp_extract_all(as_col(html), F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>"), F.lit(1))
    return F.transform(inner, html_text)


def paragraphs(html) -> Column:
    """Visible text of each ``<p>`` block; tolerates unclosed ``<p>``: a
    block runs until the next ``<p>`` or the end of the fragment."""
    pieces = F.split(as_col(html), r"(?i)<p\b[^>]*>")
    texts = F.transform(F.slice(pieces, 2, 1 << 30), html_text)
    return F.filter(texts, lambda t: t != F.lit(""))


def positional(arr, positions: list[int], names: list[str]) -> list[Column]:
    """0-based positions of a list -> named columns (short list -> null)."""
    return [F.get(as_col(arr), p).alias(n) for p, n in zip(positions, names)]


def count_from_text(text) -> Column:
    """X6: "1.234 việc làm" -> 1234 (dots are digit grouping); no digits -> null."""
    digits = F.regexp_extract(F.replace(as_col(text), F.lit("."), F.lit("")), r"\d+", 0)
    return digits.try_cast("int")
