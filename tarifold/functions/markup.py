"""Landed pages as one array of tokens and one of elements, built in a single pass.

A page is cut into tags, comments and whole scripts on the one hand and the texts between them on the other. One walk over
the tags with a stack gives every element its closing place; a stack that grows and shrinks has no built-in in linear time (an
aggregate copies its state at every step), so this one step runs on Arrow batches. Selectors are column functions: they read
the intervals and never the page again. This is what shop pages need, not a selector engine.
"""

from __future__ import annotations

import html as references
import re
import sys
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

# What is not text: comments, whole scripts and styles, tags (quotes count behind "=" only), declarations.
TOKEN = (
    r"(?is)<!--.*?-->|<(?:script\b[^>]*+>.*?</script|style\b[^>]*+>.*?</style)\s*+>|"
    r"""</?[a-z](?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+>|<[!?][^>]*+>"""
)
# Elements without content, and elements that end where the next of their kind begins (up to a holder).
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
IMPLIED = {
    "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "p": ({"p"}, {"div", "td", "th", "li", "section", "article"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr"}), "th": ({"td", "th"}, {"tr"}),
}

# What is cut into tokens and elements before it is handed on.
PAGES_PER_RUN = 256
CHARACTERS_PER_RUN = 1 << 20

_TOKEN = re.compile(TOKEN)
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")

_TEXTS = pa.list_(pa.string())
_NODE = pa.struct([
    ("open", pa.int32()), ("close", pa.int32()), ("last", pa.int32()), ("at", pa.int32()), ("after", pa.int32()), ("tag", pa.string()),
    ("name", pa.string()), ("classes", pa.string()), ("names", _TEXTS), ("values", _TEXTS),
])
_PAGE = pa.struct([("tokens", _TEXTS), ("gaps", _TEXTS), ("texts", _TEXTS), ("nodes", pa.list_(_NODE))])
# Executors get the walk with the task, whether or not the package is installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _cut(html: str) -> tuple[list[str], list[str]]:
    """Tokens, and the markup before each of them and behind the last."""
    tokens, gaps, at = [], [], 0
    for m in _TOKEN.finditer(html):
        gaps.append(html[at:m.start()])
        tokens.append(m[0])
        at = m.end()
    return tokens, [*gaps, html[at:]]


def _walk(tokens: list[str], nodes: dict[str, list] | None = None) -> list[str]:
    """Elements in page order, appended to the columns of ``nodes``, of which that of the tags is returned. A closing tag also
    ends what is open inside its element, and is nothing where none is open."""
    nodes = {field.name: [] for field in _NODE} if nodes is None else nodes
    close, last, after, names = nodes["close"], nodes["last"], nodes["after"], nodes["name"]
    base, stack, held = len(names), [], Counter()

    def end(i: int, place: int, closes: bool) -> None:
        count = len(names) - base
        for n in range(place, len(stack)):
            node = stack[n]
            close[node], last[node], after[node] = i, i if closes and n == place else i - 1, count
            held[names[node]] -= 1
        del stack[place:]

    def opened(wanted: set[str], up_to: set[str]) -> int | None:
        """Where the last wanted element is open, unless one of the others was opened since."""
        if any(held[w] for w in wanted):
            for n in range(len(stack) - 1, -1, -1):
                name = names[stack[n]]
                if name in wanted:
                    return n
                if name in up_to:
                    return None
        return None

    for i, token in enumerate(tokens):
        m = _NAME.match(token)
        if not m:
            continue
        closes, name = m[1] == "/", m[2].lower()
        place = opened({name}, set()) if closes else opened(*IMPLIED[name]) if name in IMPLIED else None
        if place is not None:
            end(i, place, closes)
        if not closes:
            at = len(names) - base
            nodes["open"].append(i)
            close.append(i)
            last.append(i)
            nodes["at"].append(at)
            after.append(at + 1)
            nodes["tag"].append(token)
            names.append(name)
            if not (name in VOID or name in ("script", "style") or token.endswith("/>")):
                stack.append(base + at)
                held[name] += 1
    end(len(tokens), 0, False)
    return nodes["tag"]


def _attributes(tag: str) -> tuple[list[str], list[str], str]:
    """Names and values of an opening tag's attributes, quoted or not, references decoded; its classes with a space around each."""
    end = tag.find(">") if tag[:7].lower() in ("<script", "<style") else len(tag)
    found = _ATTRIBUTE.findall(tag, _NAME.match(tag).end(), end) if "=" in tag[:end] else []
    names = [name.lower() for name, _ in found]
    values = [references.unescape(v[1:-1] if v[:1] in ("'", '"') else v) for _, v in found]
    classes = values[names.index("class")].split() if "class" in names else []
    return names, values, f" {' '.join(classes)} "


def _lists(flat: list | pa.Array, ends: list[int], kind: pa.DataType) -> pa.Array:
    """Consecutive runs of ``flat``, each up to its end, as one array of lists."""
    values = flat if isinstance(flat, pa.Array) else pa.array(flat, kind)
    return pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), values, pa.list_(kind))


def _pages(texts: list[str]) -> pa.Array:
    """``_PAGE`` rows, built column by column."""
    tokens, gaps, words, token_ends, gap_ends, node_ends = [], [], [], [], [], []
    nodes = {field.name: [] for field in _NODE}
    for text in texts:
        cut, between = _cut(text)
        _walk(cut, nodes)
        tokens += cut
        gaps += between
        words += [references.unescape(g).strip() for g in between]
        token_ends.append(len(tokens))
        gap_ends.append(len(gaps))
        node_ends.append(len(nodes["tag"]))
    ends, read = [], {}
    for tag in nodes["tag"]:
        found = read.get(tag)
        if found is None:
            found = read[tag] = _attributes(tag)
        names, values, classes = found
        nodes["names"] += names
        nodes["values"] += values
        nodes["classes"].append(classes)
        ends.append(len(nodes["names"]))
    string = pa.string()
    columns = [_lists(nodes[f.name], ends, string) if f.type == _TEXTS else pa.array(nodes[f.name], f.type) for f in _NODE]
    elements = _lists(pa.StructArray.from_arrays(columns, fields=list(_NODE)), node_ends, _NODE)
    lists = [_lists(tokens, token_ends, string), _lists(gaps, gap_ends, string), _lists(words, gap_ends, string), elements]
    return pa.StructArray.from_arrays(lists, fields=list(_PAGE))


def _runs(html: pa.Array) -> Iterator[list[str]]:
    """The texts of a batch in runs of a bounded size, at least one text each."""
    run, size = [], 0
    for text in html:
        text = text.as_py() or ""
        if run and (len(run) == PAGES_PER_RUN or size + len(text) > CHARACTERS_PER_RUN):
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run


@F.arrow_udf(from_arrow_type(_PAGE))
def _page(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    # A page's tokens and elements are many times its text, so a batch is given back in parts and never held whole.
    for html in batches:
        for run in _runs(html):
            yield _pages(run)


def with_page(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``_page``: ``struct<tokens, gaps, texts, nodes>``.

    ``gaps[i]`` is the markup before ``tokens[i]``, ``texts`` are the gaps decoded and stripped, ``nodes`` the elements in page
    order: the token that opens them (``open``, text ``tag``), the one before which their content ends (``close``), the last one
    of their markup, their own number (``at``) and that behind their last descendant (``after``), name and attributes.
    """
    return pages.withColumn("_page", _page(F.col(html)))


# --- selectors ----------------------------------------------------------------------------------

def value_of(node: Column, name: str) -> Column:
    """The attribute's first value, ``""`` if absent."""
    at = F.array_position(node["names"], name).cast("int")
    return F.coalesce(F.get(node["values"], F.nullif(at, F.lit(0)) - 1), F.lit(""))


def by_name(*names: str):
    return lambda n: n["name"].isin(*names)


def with_class(name: str):
    """Condition: ``name`` is one of the classes."""
    return lambda n: n["classes"].contains(f" {name} ")


def class_matches(pattern: str):
    return lambda n: n["classes"].rlike(pattern)


def with_attribute(name: str, value: str):
    return lambda n: value_of(n, name) == value


def elements(page: Column, condition) -> Column:
    return F.filter(page["nodes"], condition)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once: in a lambda it would be worked out for every element."""
    return F.transform(F.array(value), use)[0]


def _part(values: Column, first: Column, last: Column) -> Column:
    """Values from one place to another, read one by one (``slice`` would copy the whole array first)."""
    places = F.when(first <= last, F.sequence(first, F.greatest(first, last)))
    return F.transform(F.coalesce(places, F.array().cast("array<int>")), lambda i: F.get(values, i))


def inside(page: Column, node: Column) -> Column:
    """An element's descendants: they follow it in page order."""
    return _let(node, lambda n: _part(page["nodes"], n["at"] + 1, n["after"] - 1))


def outermost(found: Column) -> Column:
    """Those of an array of elements, in page order, that are in no other."""
    zero = F.struct(F.lit(0).alias("after"), F.filter(found, lambda n: F.lit(False)).alias("kept"))

    def step(s: Column, n: Column) -> Column:
        return F.when(n["at"] < s["after"], s).otherwise(F.struct(n["after"].alias("after"), F.concat(s["kept"], F.array(n)).alias("kept")))

    return F.aggregate(found, zero, step, lambda s: s["kept"])


def descendants(page: Column, found: Column, condition) -> Column:
    """Matching elements inside any of ``found``, each once, in page order."""
    return F.flatten(F.transform(outermost(found), lambda n: F.filter(inside(page, n), condition)))


def first(found: Column) -> Column:
    return F.try_element_at(found, F.lit(1))


def text_of(page: Column, node: Column, between: str = "") -> Column:
    """An element's texts, each stripped; NULL without an element."""

    def joined(n: Column) -> Column:
        texts = _part(page["texts"], n["open"] + 1, n["close"])
        return F.when(n.isNotNull(), F.array_join(F.filter(texts, lambda t: t != "") if between else texts, between))

    return _let(node, joined)


def markup_of(page: Column, node: Column) -> Column:
    """An element with its tags as it stands in the page; NULL without an element."""

    def joined(n: Column) -> Column:
        tokens, gaps = _part(page["tokens"], n["open"] + 1, n["last"]), _part(page["gaps"], n["open"] + 1, n["last"])
        rest = F.array_join(F.zip_with(gaps, tokens, lambda g, t: F.concat(g, t)), "")
        open_end = F.when(n["last"] < n["close"], F.get(page["gaps"], n["close"])).otherwise("")
        return F.concat(n["tag"], rest, open_end)

    return _let(node, joined)


def scripts_of_type(page: Column, mime: str) -> Column:
    """Bodies of the scripts of a type, in page order."""
    found = elements(page, lambda n: (n["name"] == "script") & (F.lower(value_of(n, "type")) == mime))
    return F.transform(found, lambda n: F.regexp_replace(n["tag"], r"(?is)^<script[^>]*>|</script\s*>$", ""))


def absolute_url(origin: Column, ref: Column) -> Column:
    """Reference resolved against the root of a site."""
    scheme = F.regexp_extract(origin, r"^[^:]+", 0)
    return (
        F.when(ref.rlike(r"(?i)^[a-z][a-z0-9+.\-]*:"), ref)
        .when(ref.startswith("//"), F.concat(scheme, F.lit(":"), ref))
        .when(ref.startswith("/"), F.concat(origin, ref))
        .when(ref == "", origin)
        .when(ref.startswith("#"), F.concat(origin, ref))
        .otherwise(F.concat(origin, F.lit("/"), ref))
    )


def origin_of(url: Column) -> Column:
    """``scheme://host`` of a url."""
    return F.regexp_extract(url, r"^([^:/?#]+://[^/?#]*)", 1)


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1)


def host_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^:/?#]+://([^/?#]*)", 1)
