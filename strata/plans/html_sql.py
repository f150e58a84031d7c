"""SQL mirror of ``strata.functions.text.html_to_text`` (DuckDB dialect)."""

from __future__ import annotations

from strata.functions.text import HTML_ENTITIES, HTML_STEPS
from strata.plans.sqlgen import STRIP, q


def html_sql(x: str) -> str:
    """The same regex steps and entity replacements, in the same order."""
    out = x
    for pat, rep in HTML_STEPS:
        r = "chr(10)" if rep == "\n" else q(rep)
        out = f"regexp_replace({out}, {q(pat)}, {r}, 'g')"
    for ent, ch in HTML_ENTITIES:
        out = f"replace({out}, {q(ent)}, {q(ch)})"
    out = f"regexp_replace({out}, {STRIP}, '', 'g')"
    return f"regexp_replace({out}, {q(chr(10) + '[ ' + chr(9) + chr(10) + chr(13) + chr(12) + ']*' + chr(10))}, " \
           f"chr(10) || chr(10), 'g')"


# the HTML wrapper of the derived file tree (mirror of ingest_q.virtual_files)
WRAP_SQL = ("'<html><head><style>p{margin:0}</style></head><body><p>' || "
            "replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), chr(10), '</p><p>') || "
            "'</p><!-- end --></body></html>'")
