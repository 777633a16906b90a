"""Pieces of DuckDB SQL that several queries share."""

from __future__ import annotations

from lathework.functions.text import WS


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def norm(x: str) -> str:
    return f"regexp_replace({strip(f'lower({x})')}, '{WS}+', ' ', 'g')"


def text(x: str) -> str:
    return f"coalesce({x}, '')"


def words(x: str) -> str:
    return f"len(list_filter(regexp_split_to_array({text(x)}, '{WS}+'), lambda w: w <> ''))"


def sentences(x: str, pattern: str) -> str:
    return f"list_filter(list_transform(regexp_split_to_array({text(x)}, '{pattern}'), lambda s: {strip('s')}), lambda s: length(s) > 20)"


def top(array: str) -> str:
    """How often the most frequent element of an array occurs."""
    return f"coalesce(list_max(map_values(list_histogram({array}))), 0)"


def phrases(x: str) -> str:
    windows = "list_transform([regexp_extract_all(t, '(?s).{15}')], lambda p: list_transform(range(1, CAST(ceil((length(t) - 30) / 15.0) AS BIGINT) + 1), lambda i: p[i] || p[i + 1]))[1]"
    return f"list_transform([{norm(text(x))}], lambda t: CASE WHEN length(t) <= 30 THEN 0 ELSE {top(windows)} END)[1]"


def repeats(x: str) -> str:
    s = sentences(x, "[.!?]+")
    return f"(len({s}) >= 2 AND {top(f'list_transform({s}, lambda s: {norm(chr(115))})')} >= 3)"


def netloc(x: str) -> str:
    return f"regexp_extract({x}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)"


def pick(key: str, seed: str, of: int) -> str:
    return f"(('0x' || substring(md5('{seed}' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT % {of} + 1)"


FILES = """files AS (
  SELECT result_id * 1000000 + (i - 1) AS key, examples[i].path AS path, examples[i].output AS source
  FROM (SELECT result_id, examples, unnest(range(1, len(examples) + 1)) AS i FROM extraction_results)
)"""

SAMPLES = "samples AS (SELECT pair_id AS seq, coalesce(instruction, '') AS instruction, coalesce(input, '') AS input, coalesce(output, '') AS output, source FROM qa_pairs)"


def urljoin(base: str, href: str) -> str:
    """A link against its page, for whole urls, links from the root, and links one folder up."""
    host, path = f"regexp_extract({base}, '^https?://[^/?#]*')", f"regexp_replace(regexp_replace({base}, '^https?://[^/?#]*', ''), '[?#].*$', '')"
    folder = f"regexp_replace({path}, '[^/]*$', '')"
    up = f"CASE WHEN regexp_matches({folder}, '^/[^/]') THEN regexp_replace({folder}, '[^/]+/$', '') ELSE '/' END"
    return f"CASE WHEN regexp_matches({href}, '^https?://') THEN {href} WHEN starts_with({href}, '/') THEN {host} || {href} ELSE {host} || {up} || substring({href}, 4) END"


def normalize_url(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '#.*$', ''), '/$', '')"


HREF = """'(?i)<a\\s[^>]*?href\\s*=\\s*["'']([^"'']*)["'']'"""
LINKS = f"""links AS (
  SELECT DISTINCT {normalize_url('base')} AS src, {normalize_url(urljoin('base', 'href'))} AS dst
  FROM (SELECT url AS base, unnest(regexp_extract_all(coalesce(html, ''), {HREF.replace(chr(92) * 2, chr(92))}, 1)) AS href FROM pages WHERE url IS NOT NULL))"""
