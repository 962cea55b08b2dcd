"""URL expressions: joining, fragments, domains.

Functions take a column name or SQL expression, so that they can be nested in
lambdas and bound to a name where a value is needed more than once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from profileloom.functions.dates import bind

# Scheme, authority, path, query and fragment as RFC 3986 appendix B splits them.
_SPLIT = r"(?s)^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
_AUTHORITY = r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)"
_PATH = r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"
# Schemes under which a scheme-only prefix still means a relative reference.
_RELATIVE_SCHEMES = "('http', 'https', 'ftp', 'file', 'ws', 'wss')"


def _parts(url: str) -> str:
    """SQL array of the five parts of a URL, from one regex pass."""
    return f"split(regexp_replace({url}, r'{_SPLIT}', '$1\\u0001$2\\u0001$3\\u0001$4\\u0001$5'), '\\u0001')"


def strip_fragment(url: str) -> Column:
    """The URL up to its first ``#``."""
    return F.expr(f"substring_index({url}, '#', 1)")


def authority(url: str) -> Column:
    """Host with port and user part as written; empty when there is none."""
    return F.expr(f"regexp_extract({url}, r'{_AUTHORITY}', 1)")


def base_domain(base_url: str) -> Column:
    """Domain that links must stay in: authority, else path, else the text itself."""
    host = f"nullif(regexp_extract({base_url}, r'{_AUTHORITY}', 1), '')"
    path = f"nullif(regexp_extract({base_url}, r'{_PATH}', 1), '')"
    return F.expr(f"coalesce({host}, {path}, {base_url})")


def in_domain(domain: str, base: str) -> Column:
    """Whether a domain is ``base`` or lies below it."""
    return F.expr(f"{domain} = {base} or endswith({domain}, concat('.', {base}))")


def domain_and_parents(domain: str) -> Column:
    """A domain with every parent: ``a.b.c`` gives ``[a.b.c, b.c, c]``.

    ``in_domain(d, base)`` is ``base in domain_and_parents(d)``, which turns the
    suffix test into an equality a join can hash on.
    """
    parents = "transform(sequence(1, size(labels)), i -> array_join(slice(labels, i, size(labels)), '.'))"
    return F.expr(bind(f"split({domain}, r'\\.')", "labels", parents))


def path_of_sql(url: str) -> str:
    """SQL of the path of a raw reference, without parameters of its last segment."""
    path = f"regexp_extract({url}, r'{_PATH}', 1)"
    return f"if(contains({url}, ';'), regexp_replace({path}, ';[^/]*$', ''), {path})"


def path_of(url: str) -> Column:
    """``path_of_sql`` of a column or SQL expression."""
    return F.expr(path_of_sql(url))


def _without_dots(path: str) -> str:
    """SQL of a path with ``.`` and ``..`` segments resolved and a leading slash."""
    walk = """array_join(aggregate(split(p, '/'), cast(array() as array<string>),
        (done, s) -> case when s = '..' then slice(done, 1, greatest(size(done) - 1, 0))
            when s = '.' then done else concat(done, array(s)) end), '/')"""
    tail = r"if(p rlike r'(^|/)\.\.?$', '/', '')"
    joined = rf"if(p rlike r'(^|/)\.\.?(/|$)', concat({walk}, {tail}), p)"
    return bind(path, "p", bind(joined, "j", "if(startswith(j, '/'), j, concat('/', j))"))


def resolve_sql(page_url: str, href: str) -> str:
    """SQL of the absolute form of ``href`` as found on ``page_url``.

    Plain absolute and rooted references, nearly all there are, take a shortcut
    around the general algorithm.
    """

    def suffixed(url: str, query: str = "r[3]") -> str:
        return (
            f"concat({url}, if({query} = '', '', concat('?', {query})), "
            "if(r[4] = '', '', concat('#', r[4])))"
        )

    root = "concat(b[0], '://', b[1])"
    directory = "concat(if(startswith(b[2], '/'), '', '/'), regexp_replace(b[2], '[^/]*$', ''))"
    # Empty inner segments vanish only when a relative path is merged.
    merged = f"regexp_replace(concat({directory}, r[2]), '(?<!^)/{{2,}}', '/')"
    forms = f"""case
        when h = '' then u
        when r[0] <> '' and (lower(r[0]) <> lower(b[0]) or lower(r[0]) not in {_RELATIVE_SCHEMES}) then h
        when r[1] <> '' then {suffixed("concat(b[0], '://', r[1], r[2])")}
        when r[2] = '' then {suffixed(f"concat({root}, b[2])", "if(r[3] = '', b[3], r[3])")}
        when startswith(r[2], '/') then {suffixed(f"concat({root}, {_without_dots('r[2]')})")}
        else {suffixed(f"concat({root}, {_without_dots(merged)})")} end"""
    general = bind(_parts("u"), "b", bind(_parts("h"), "r", forms))
    plain = "not endswith(h, '?') and not endswith(h, '#') and not contains(h, '?#')"
    rooted = "startswith(h, '/') and not startswith(h, '//') and not contains(h, '/.')"
    shortcut = f"""case
        when h rlike r'^https?://[^/?#]' and {plain} then h
        when {rooted} and {plain} and u rlike '^[a-z]+://'
            then concat(regexp_extract(u, r'^[a-z]+://[^/?#]*', 0), h)
        else {general} end"""
    return bind(page_url, "u", bind(href, "h", shortcut))


def resolve(page_url: str, href: str) -> Column:
    """``resolve_sql`` of columns or SQL expressions."""
    return F.expr(resolve_sql(page_url, href))
