"""Fragments of equivalent SQL. They say the same as the operators in another engine's terms."""

from __future__ import annotations

from ..rules import dictionaries as D
from ..rules import settings as S
from ..rules import tagging as T
from ..rules import wording as W


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^[\s\x{{A0}}]+|[\s\x{{A0}}]+$', '', 'g')"


def title_case(x: str) -> str:
    return (
        rf"array_to_string(list_transform(regexp_extract_all({x}, '[^\p{{L}}]+|\p{{L}}+'), "
        "lambda w: CASE WHEN w[1] = 'ß' THEN 'Ss' ELSE upper(w[1]) END || lower(w[2:])), '')"
    )


def joined(x: str) -> str:
    return f"coalesce(array_to_string({x}, '|'), '')"


def in_list(values) -> str:
    return "(" + ", ".join(quote(v) for v in values) + ")"


def dictionary(x: str, table: dict[str, str]) -> str:
    whens = " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in table.items())
    return f"CASE {x} {whens} END"


def brand(x: str) -> str:
    bare = strip(f"coalesce({x}, '')")
    return f"coalesce({dictionary(f'lower({bare})', D.BRAND_NAMES)}, {title_case(bare)})"


def make(x: str) -> str:
    bare = strip(f"coalesce({x}, '')")
    known = {m.lower(): m for m in reversed(D.MAKES)} | D.MAKE_NAMES
    return f"coalesce({dictionary(f'lower({bare})', known)}, {title_case(bare)})"


def has(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {quote(pattern)}, 'i')"


def cents(x: str) -> str:
    return f"floor(({x}) * 100e0 + 5e-1) / 100e0"


def to_95(x: str) -> str:
    return f"floor(({x}) + 55e-2) - 5e-2"


def money(x: str) -> str:
    return f"printf('%.2f', {cents(x)})"


def title_terms(x: str) -> str:
    for pattern, text in W.TITLE_TERMS:
        flags = "g" if pattern in W.CASE_SENSITIVE_TERMS else "gi"
        if "(?=" in pattern:
            pattern, text = pattern.replace("(?=", "("), text + r"\1"
        x = f"regexp_replace({x}, {quote(pattern)}, {quote(text)}, '{flags}')"
    return strip(x)


def clean(x: str) -> str:
    cleaned = x
    for kind in [S.Store.source_keyword, *W.UNWANTED_SENTENCES]:
        cleaned = f"regexp_replace({cleaned}, {quote(f'[^<.!?]*({kind})[^<.!?]*[.!?]?')}, '', 'gi')"
    cleaned = rf"regexp_replace({cleaned}, '[ \t]{{2,}}', ' ', 'g')"
    cleaned = rf"regexp_replace({cleaned}, '(<br\s*/?>|\n){{3,}}', '<br>', 'gi')"
    return f"CASE WHEN {x} = '' THEN {x} ELSE {strip(cleaned)} END"


def tag_slug(x: str) -> str:
    words = rf"regexp_replace({strip(x)}, '[^\p{{L}}\p{{M}}\p{{N}}_]', '_', 'g')"
    return f"regexp_replace(regexp_replace({words}, '_+', '_', 'g'), '^_+|_+$', '', 'g')"


def url_slug(x: str) -> str:
    plain = rf"regexp_replace(strip_accents({x}), '[^\x00-\x7F]', '', 'g')"
    return f"regexp_replace(regexp_replace(lower({plain}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"


def type_label(x: str) -> str:
    return "CASE " + " ".join(f"WHEN {has(x, p)} THEN {quote(l)}" for p, l in T.TYPE_RULES) + " END"


def material_labels(x: str) -> str:
    cases = ", ".join(f"CASE WHEN {has(x, p)} THEN {quote(l)} END" for p, l in T.MATERIAL_RULES)
    return f"list_filter([{cases}], lambda m: m IS NOT NULL)"


def euro(x: str) -> str:
    return f"'EURO_' || nullif(regexp_extract({x}, {quote(T.EURO_PATTERN)}, 1, 'i'), '')"


def road(x: str) -> str:
    return (
        f"CASE WHEN {has(x, T.HOMOLOGATED_PATTERN)} THEN 'HOMOLOGATED' "
        f"WHEN {has(x, T.RACE_ONLY_PATTERN)} THEN 'RACE_ONLY' END"
    )


def category(x: str) -> str:
    return f"CASE WHEN {x} <> '' AND lower({x}) NOT IN {in_list(D.CATEGORY_DENYLIST)} THEN 'CAT_' || {tag_slug(x)} END"


def named(prefix: str, x: str) -> str:
    return f"CASE WHEN {x} <> '' THEN '{prefix}' || {tag_slug(x)} END"


def clean_year(x: str) -> str:
    y = rf"regexp_replace({x}, '\s*[–—]\s*', '-', 'g')"
    y = rf"regexp_replace({y}, '\s*/\s*', '-', 'g')"
    y = rf"regexp_replace({y}, '\s+\+', '+', 'g')"
    y = rf"regexp_replace({y}, '\s+', '', 'g')"
    return rf"regexp_replace({y}, '(20\d{{2}})-(\d{{2}})$', '\1-20\2')"


def years(x: str, as_of: int) -> str:
    first, last = f"CAST(substr({x}, 1, 4) AS INT)", f"CAST(substr({x}, 6, 4) AS INT)"
    span = "list_transform(range({}, {} + 1), lambda y: CAST(y AS VARCHAR))"
    closed = rf"regexp_matches({x}, '^20\d\d-20\d\d$') AND {first} <= {last} AND {last} <= 2040"
    open_ended = rf"regexp_matches({x}, '^20\d\d\+$') AND {first} <= {as_of}"
    return (
        f"CASE WHEN {closed} THEN {span.format(first, last)} "
        f"WHEN {open_ended} THEN list_append({span.format(first, as_of)}, {x}) "
        f"WHEN {x} <> '' THEN [{x}] ELSE [] END"
    )


def tags(as_of: int, sale: str, site: str = S.Store.source_site) -> str:
    """Tag list over the columns brand, make, model, year, title, description_nl, product_type."""
    text = "(title || ' ' || description_nl)"
    year_tags = f"list_transform({years('year', as_of)}, lambda y: 'YEAR_' || y)"
    materials = f"list_transform({material_labels(text)}, lambda m: 'MAT_' || m)"
    lists = [
        f"[{named('BRAND_', 'brand')}, {named('MAKE_', 'make')}, {named('MODEL_', 'model')}]",
        year_tags, f"['TYPE_' || {type_label(text)}]", materials,
        f"[{euro(text)}, {road(text)}, {category('product_type')}, 'source:{site}', CASE WHEN {sale} THEN 'SALE' END]",
    ]
    return f"list_filter(list_concat({', '.join(lists)}), lambda t: t IS NOT NULL)"


def product_type(tag_list: str) -> str:
    cases = dictionary(f"list_filter({tag_list}, lambda t: starts_with(t, 'TYPE_'))[1]", T.PRODUCT_TYPES)
    return f"coalesce({cases}, {quote(T.DEFAULT_PRODUCT_TYPE)})"


def words(*parts: str) -> str:
    return "concat_ws(' ', " + ", ".join(f"nullif({p}, '')" for p in parts) + ")"


def seo_title(brand: str, kind: str, store: str = S.Store.name) -> str:
    bike = f"'for ' || nullif({words('make', 'model', 'year')}, '')"
    return f"substr(concat_ws(' ', nullif({brand}, ''), nullif({kind}, ''), {bike}) || ' | {store}', 1, 70)"


def meta_description(brand: str, kind: str, store: str = S.Store.name) -> str:
    bike = f"coalesce(nullif(trim({words('make', 'model', 'year')}), ''), 'your motorcycle')"
    return (
        f"substr({brand} || ' ' || coalesce(nullif({kind}, ''), 'exhaust') || ' for the ' || {bike} || "
        f"'. Upgrade your exhaust at {store} — worldwide shipping.', 1, 150)"
    )


def alt_text(brand: str, kind: str) -> str:
    bike = f"CASE WHEN make <> '' OR model <> '' THEN 'for ' || {words('make', 'model', 'year')} END"
    return f"concat_ws(' ', nullif({brand}, ''), nullif({kind}, ''), {bike})"


def sorted_tokens(x: str) -> str:
    return rf"array_to_string(list_sort(list_filter(string_split_regex({x}, '\s+'), lambda t: t <> '')), ' ')"


# Longest common subsequence of each (a, b) of table ``pairs``, columns a, b, la, lb, mask and code, with one bit for each
# position of a: ``mask`` has the positions of every character of the alphabet, ``code`` the characters of b by number.
# Texts of up to 120 characters.
_FULL = "((1::HUGEINT << la::INT) - 1)"
SIMILARITY = f"""2e0 * (la - bit_count(list_reduce(list_prepend({_FULL}, list_transform(code, lambda c: coalesce(mask[c], 0::HUGEINT))),
  lambda v, m: ((v + (v & m)) | (v - (v & m))) & {_FULL}))) / (la + lb)"""


def coded(table: str, text: str, other: bool = False) -> str:
    """Distinct texts of a column with their length, character counts and masks (or numbers, for the other side); needs
    the table ``chars(cs)``, the alphabet as a list."""
    counts = f"list_transform(cs, lambda c: length({text}) - length(replace({text}, c, '')))"
    masks = (f"list_transform(cs, lambda c: list_sum(list_transform(range(1, length({text}) + 1), lambda i: "
             f"CASE WHEN substr({text}, i, 1) = c THEN 1::HUGEINT << (i - 1)::INT ELSE 0 END))::HUGEINT) AS mask")
    codes = f"list_transform(string_split({text}, ''), lambda c: list_position(cs, c)) AS code"
    side = "b" if other else "a"
    return (f"SELECT {text} AS {side}, length({text}) AS l{side}, {counts} AS n{side}, {codes if other else masks} "
            f"FROM (SELECT DISTINCT {text} FROM {table} WHERE {text} <> ''), chars")


def alphabet(table: str, text: str) -> str:
    return f"SELECT list(DISTINCT c) AS cs FROM (SELECT unnest(string_split({text}, '')) AS c FROM (SELECT DISTINCT {text} FROM {table}))"
