"""Link and URL expressions (S8–S10, M10, M11), all in Catalyst."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a tag holds behind its name, up to its ``>``: values in quotes (only behind an equals sign, where a quote
# opens a value), bare values, and all else.  Possessive groups are matched in a loop, whatever the length.
_INSIDE = r"""(?:=\s*+"[^"]*+"|=\s*+'[^']*+'|=\s*+[^\s"'>][^\s>]*+|=\s*+(?=>)|[^=>]++)*+"""
# Elements whose content is text up to their own end tag.
_TEXT_ELEMENTS = "script|style|textarea|title|xmp|iframe|noembed|noframes"
# One alternative for each state a page's reader can be in; the scan goes from token to token:
TOKEN_PATTERN = (
    r"(?is)<!--(?:-?>|.*?(?:--!?>|\z))"  # a comment
    r"|<[!?][^>]*+(?:>|\z)|</(?![a-z])[^>]*+(?:>|\z)"  # a declaration, or what is no tag
    rf"|<({_TEXT_ELEMENTS})(?=[\s/>]){_INSIDE}>.*?(?:</\1(?=[\s/>]){_INSIDE}(?:>|\z)|\z)"  # an element of text, with its content
    rf"|<a(?=[\s/>])({_INSIDE})>"  # a link: its attributes are group 2
    rf"|</?[a-z]{_INSIDE}>"  # another tag
    rf"|</?[a-z]{_INSIDE}(?:=\s*+[\"'].*+)?+\z"  # a tag that never ends, as its last quote doesn't
)
ATTRIBUTE_PATTERN = r"""[^\s>=/]++\s*+(?:=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)?+)?+"""
HREF_PATTERN = r"(?is)^href\s*+=\s*+(.*)$"
# White space around a value, and the quotes around a quoted one.
VALUE_PATTERN = r"""(?s)^(["'])(.*)\1$"""
EDGES_PATTERN = r"^\s+|\s+$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def extract_hrefs(html) -> Column:
    """The ``href`` value of every ``<a>`` tag that has one, in page order
    (array<string>).

    The page is read token by token, as a parser does: what stands in comments,
    in scripts, styles, text areas, titles and the like, or in the value of
    another attribute is no link; a tag whose quote is never closed swallows
    the rest of the page; of repeated ``href`` attributes the first counts."""
    tags = F.filter(F.regexp_extract_all(_col(html), F.lit(TOKEN_PATTERN), F.lit(2)), lambda a: a != "")
    own = F.transform(tags, lambda a: F.get(F.filter(F.regexp_extract_all(a, F.lit(ATTRIBUTE_PATTERN), F.lit(0)), lambda x: x.rlike(HREF_PATTERN)), F.lit(0)))
    values = F.transform(F.filter(own, lambda x: x.isNotNull()), lambda x: F.regexp_extract(x, HREF_PATTERN, 1))
    return F.transform(values, lambda v: F.regexp_replace(F.regexp_replace(F.regexp_replace(v, EDGES_PATTERN, ""), VALUE_PATTERN, "$2"), EDGES_PATTERN, ""))


def _char_sql(cp: str) -> str:
    """SQL text: the character of Unicode code point ``cp`` (via UTF-16BE
    bytes, surrogate pair above U+FFFF); NULL for invalid code points."""
    return (f"CASE WHEN {cp} BETWEEN 1 AND 55295 OR {cp} BETWEEN 57344 AND 65535 "
            f"THEN decode(unhex(lpad(hex({cp}), 4, '0')), 'UTF-16BE') "
            f"WHEN {cp} BETWEEN 65536 AND 1114111 THEN decode(unhex(concat(hex(55296 + shiftright({cp} - 65536, 10)), "
            f"hex(56320 + (({cp} - 65536) & 1023)))), 'UTF-16BE') END")


def decode_entities_sql(column: str) -> str:
    """SQL text decoding the HTML entities of an attribute value: numeric
    (``&#233;``, ``&#xE9;``) and the named ones of the standard library's
    table, which need their semicolon.  The value is cut at every ``&`` and
    each part decoded once, so ``&amp;#233;`` becomes the text ``&#233;``."""
    dec = "regexp_extract(p, '^#([0-9]{1,7});', 1)"
    hx = "regexp_extract(p, '^#[xX]([0-9a-fA-F]{1,6});', 1)"
    name = "regexp_extract(p, '^([A-Za-z][A-Za-z0-9]*);', 1)"
    d_cp, h_cp = f"CAST({dec} AS INT)", f"CAST(conv({hx}, 16, 10) AS INT)"
    known = ", ".join(f"'{n}', {cp}" for n, cp in sorted({**name2codepoint, "apos": 39}.items()))
    n_cp = f"element_at(map({known}), {name})"
    part = (f"CASE WHEN p RLIKE '^#[0-9]{{1,7}};' AND ({_char_sql(d_cp)}) IS NOT NULL "
            f"THEN concat({_char_sql(d_cp)}, substr(p, length({dec}) + 3)) "
            f"WHEN p RLIKE '^#[xX][0-9a-fA-F]{{1,6}};' AND ({_char_sql(h_cp)}) IS NOT NULL "
            f"THEN concat({_char_sql(h_cp)}, substr(p, length({hx}) + 4)) "
            f"WHEN p RLIKE '^[A-Za-z][A-Za-z0-9]*;' AND {n_cp} IS NOT NULL "
            f"THEN concat(transform(array({n_cp}), c -> {_char_sql('c')})[0], substr(p, length({name}) + 2)) "
            f"ELSE concat('&', p) END")
    col = _q(column)
    decoded = (f"transform(array(split({col}, '&')), s -> concat(s[0], "
               f"array_join(transform(slice(s, 2, greatest(size(s) - 1, 0)), p -> {part}), '')))[0]")
    # most values hold no entity: skip the split for them
    return f"CASE WHEN instr({col}, '&') = 0 THEN {col} ELSE {decoded} END"


def decode_entities(column: str) -> Column:
    """Decode HTML entities in the text column ``column`` (see
    :func:`decode_entities_sql`)."""
    return F.expr(decode_entities_sql(column))


def _dot_free_sql(path: str) -> str:
    """SQL text: remove ``.`` and ``..`` segments from an absolute path
    (``/a/b/../c/./d`` -> ``/a/c/d``); empty inner segments are dropped and
    a path ending in a dot segment keeps a trailing slash."""
    stack = ("aggregate(filter(slice(s, 2, greatest(size(s) - 1, 0)), (x, i) -> x <> '' OR i = size(s) - 2), "
             "CAST(array() AS ARRAY<STRING>), (acc, x) -> CASE WHEN x = '..' THEN slice(acc, 1, greatest(size(acc) - 1, 0)) "
             "WHEN x = '.' THEN acc ELSE concat(acc, array(x)) END)")
    return (f"transform(array(split({path}, '/')), s -> concat('/', array_join(CASE WHEN element_at(s, -1) IN ('.', '..') "
            f"THEN concat({stack}, array('')) ELSE {stack} END, '/')))[0]")


def resolve_url_sql(base: str, href: str) -> str:
    """SQL text of :func:`resolve_url` over two column names."""
    b, h = _q(base), _q(href)
    origin = f"regexp_extract({b}, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)"
    no_frag = f"regexp_replace({b}, '#.*$', '')"
    no_query = f"regexp_replace({no_frag}, '\\\\?.*$', '')"
    directory = f"coalesce(nullif(regexp_replace(substr({no_query}, length({origin}) + 1), '[^/]*$', ''), ''), '/')"
    hpath = f"regexp_extract({h}, '^[^?#]*', 0)"
    hrest = f"substr({h}, length({hpath}) + 1)"
    return (f"CASE WHEN {h} RLIKE '^[A-Za-z][A-Za-z0-9+.-]*:' THEN {h} "
            f"WHEN startswith({h}, '//') THEN concat(regexp_extract({b}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1), ':', {h}) "
            f"WHEN startswith({h}, '/') THEN concat({origin}, {_dot_free_sql(hpath)}, {hrest}) "
            f"WHEN {h} = '' THEN {no_frag} "
            f"WHEN startswith({h}, '#') THEN concat({no_frag}, {h}) "
            f"WHEN startswith({h}, '?') THEN concat({no_query}, {h}) "
            f"ELSE concat({origin}, {_dot_free_sql(f'concat({directory}, {hpath})')}, {hrest}) END")


def resolve_url(base: str, href: str) -> Column:
    """Resolve the link in column ``href`` against the page URL in column
    ``base`` like a browser: absolute, ``//host``, ``/path``, ``?query``,
    ``#fragment`` and relative forms, with ``.``/``..`` segments removed
    from the path."""
    return F.expr(resolve_url_sql(base, href))


def url_file_name(url) -> Column:
    """Last path part of a URL with the query cut off."""
    return F.substring_index(F.substring_index(_col(url), "/", -1), "?", 1)


def file_stem(name) -> Column:
    """File name up to its first dot."""
    return F.substring_index(F.substring_index(_col(name), "/", -1), ".", 1)
