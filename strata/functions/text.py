"""Column expressions for text (all JVM-side, inside whole-stage codegen).

Regexes use explicit ASCII classes (never ``\\s``/``\\w``/``\\b``) so Java and
RE2 (the SQL oracle) agree on Unicode input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata import config as C


def lit_re(p: str) -> Column:
    return F.lit(p)


def tokens(col) -> Column:
    """Whitespace tokens (pluggable tokenizer seam: the default counts words)."""
    return F.regexp_extract_all(col, lit_re(C.WS_TOKEN_RE), 0)


def token_count(col) -> Column:
    return F.size(tokens(col))


def strip_ws(col) -> Column:
    """Python-style strip of ASCII whitespace on both ends (``trim`` only drops spaces)."""
    return F.btrim(col, F.lit(" \t\n\r\f"))


def strip_bom(col) -> Column:
    return F.regexp_replace(col, lit_re("^﻿"), "")


def tier_of(doc_id_col) -> Column:
    """Document -> access tier (general / level_q / admin) by id residue."""
    d = F.pmod(doc_id_col, F.lit(3))
    return F.when(d == 0, "general").when(d == 1, "level_q").otherwise("admin")


def entity_type(title_col) -> Column:
    expr = None
    for pat, typ in C.TYPE_RULES:
        cond = title_col.like(pat)
        expr = F.when(cond, typ) if expr is None else expr.when(cond, typ)
    return expr.otherwise(C.DEFAULT_TYPE)


# HTML entities decoded after tag stripping; '&amp;' last so '&amp;lt;' stays '&lt;'.
HTML_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
                 ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))

HTML_STEPS = (
    # (pattern, replacement) applied in order
    ("(?s)<!--.*?-->", ""),
    ("(?is)<script[^>]*>.*?</script[^>]*>", ""),
    ("(?is)<style[^>]*>.*?</style[^>]*>", ""),
    ("(?i)</(p|div|h[1-6])[ \t\n\r\f]*>", "\n"),
    ("(?i)<br[^>]*>", "\n"),
    ("<[^>]*>", ""),
)


def html_to_text(col) -> Column:
    """Newline at the end of p/div/h1-h6 and after br; script, style and
    comments dropped; tags stripped; entities decoded; stripped; a run of
    blank lines collapses to one blank line."""
    out = col
    for pat, rep in HTML_STEPS:
        out = F.regexp_replace(out, lit_re(pat), rep)
    for ent, ch in HTML_ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    out = strip_ws(out)
    return F.regexp_replace(out, lit_re("\n[ \t\n\r\f]*\n"), "\n\n")


def csv_field(col) -> Column:
    return F.concat(F.lit('"'), F.replace(col.cast("string"), F.lit('"'), F.lit('""')), F.lit('"'))


def stem_of(path_col) -> Column:
    return F.regexp_extract(path_col, "([^/]*?)(\\.[^./]*)?$", 1)


def ext_of(path_col) -> Column:
    return F.regexp_extract(path_col, "(\\.[^./]*)$", 1)
