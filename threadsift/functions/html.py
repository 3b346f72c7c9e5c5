"""Column builders over saved HTML.

The reference walks a live DOM; here each page or unit is a string column and every
extraction is an expression evaluated row by row on the executors.  One pass over the
markup gives its ``outline``: every element with its depth and where it begins and ends;
``with_markup`` puts it in a column that all extractions of a unit read.  Units and
functions work on inner markup.  Entity decoding covers the
common named entities only.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift.functions.text import ARABIC_DIGITS, ASCII_DIGITS, BIDI_MARKS, col_, py_strip

# ---------------------------------------------------------------------------
# Words and patterns of the engagement, author, timestamp and
# image rules.
# ---------------------------------------------------------------------------
ENGAGEMENT_SKIP_WORDS = ["more", "view", "most relevant", "write", "be the first",
                         "عرض", "المزيد", "أهم", "اكتب", "كن أول"]
LINE_COMMENTS = r"(\d[\d,\.]*\s*[KkMm]?)\s*(?:comments?\b|تعليق)"
LINE_SHARES = r"(\d[\d,\.]*\s*[KkMm]?)\s*(?:shares?\b|مشاركات?|مشاركة)"
NODE_COMMENTS = r"^([0-9٠-٩][0-9٠-٩.,]*\s*[KkMm]?)\s*(?:comments?|تعليق\S*|كومنت\S*)$"
NODE_SHARES = r"^([0-9٠-٩][0-9٠-٩.,]*\s*[KkMm]?)\s*(?:shares?|مشارك\S*|مرة مشاركة)$"
NODE_MAX_CHARS = 25
LINE_MAX_CHARS = 40
REACTION_WORDS = ["like", "react"]
REACTION_WORDS_AR = ["اعجب", "أعجب"]
REACTION_NUMBER = r"([\d,٠-٩\.]+\s*[KkMm]?)"
BAD_AUTHOR_WORDS = [
    "مشرف", "خبير", "مساهم", "صاعد", "بارز", "متابعة", "مهتم",
    "interested", "follow", "share", "like", "reply", "comment",
    "more", "show", "عرض", "اكتب", "اقرأ", "http", "www",
    "منذ", "ago", "ساعة", "دقيقة", "يوم", "hour", "min", "day",
    "group", "expert", "contributor", "rising", "posts",
]
AUTHOR_LINK_HOSTS = ["facebook.com", "/profile.php", "/user/", "/groups/"]
ARTICLE_AUTHOR_HOSTS = ["facebook.com", "/profile.php"]
MESSAGE_MARKS = ['data-ad-rendering-role="story_message"', 'data-ad-preview="message"', 'data-ad-comet-preview="message"']
COMMENT_BASE = r"^(https?://[^/]+/groups/[^/]+/posts/\d+/)"
TIMESTAMP_BAD_WORDS = ["facebook", "http", "share", "مشاركة"]
TIMESTAMP_MAX_CHARS = 30
IMAGE_HOST_MARK, IMAGE_CDN_MARK = "fbcdn.net", "scontent"
IMAGE_EXCLUDE = ["profile", "emoji", "rsrc.php"]
SKELETON_MAX_HTML, ARTICLE_MIN_HTML = 1500, 2000
CONTAINER_LEVELS, CONTAINER_MIN_HTML = (4, 7), 5000
COMMENT_MAX_HTML, POST_MIN_HTML = 3000, 5000
BODY_MIN_CHARS, BODY_SHORT = 5, 10
# End of fixed values.
# ---------------------------------------------------------------------------

ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def _any(c: Column, words: list[str]) -> Column:
    out = None
    for w in words:
        t = c.contains(w)
        out = t if out is None else (out | t)
    return out


def first(arr: Column) -> Column:
    """First element or NULL for an empty array."""
    return F.try_element_at(arr, F.lit(1))


def decode_entities(c) -> Column:
    x = col_(c)
    for a, b in ENTITIES:
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


_N = [0]


def _name(x: str) -> str:
    _N[0] += 1
    return f"{x}{_N[0]}"


def let(value: str, body) -> str:
    """SQL: ``body(name)`` with ``value`` evaluated once under that name."""
    v = _name("v")
    return f"element_at(transform(array({value}), {v} -> {body(v)}), 1)"


def _cut(h: str, tag: str, body) -> str:
    """SQL: body(m, g, d) over the tags of one name, the texts between them (one more) and the depth after each tag."""
    pat = f"r'(?is)</?(?:{tag})\\b[^>]*>'"

    def depths(s):
        a, t = _name("a"), _name("t")
        step = f"{a}.d + CASE WHEN startswith({t}, '</') THEN -1 ELSE 1 END"
        fold = (f"aggregate({s}.m, named_struct('d', 0, 'o', CAST(array() AS array<int>)), "
                f"({a}, {t}) -> named_struct('d', {step}, 'o', concat({a}.o, array({step}))), {a} -> {a}.o)")
        return let(fold, lambda d: body(f"{s}.m", f"{s}.g", d))
    return let(h, lambda x: let(f"named_struct('m', regexp_extract_all({x}, {pat}, 0), 'g', split({x}, {pat}, -1))", depths))


def _ends(d: str, i: str, n: str) -> str:
    k = _name("k")
    return f"coalesce(get(filter(sequence(0, {n} - 1), {k} -> {k} > {i} AND {d}[{k}] = {d}[{i}] - 1), 0), {n})"


#: names of the tags that extractions look for, and one such tag
TAG_NAMES = ["div", "span", "a", "h2", "h3"]
_TAG = "r'(?is)</?(?:" + "|".join(TAG_NAMES) + ")\\b[^>]*>'"
_ELEMENTS = "array<struct<pos:int,n:string,t:string,d:int,s:int,e:int,f:int>>"
_RUN = 32


def _running(numbers: str) -> str:
    """SQL: running sums of a non-empty array<int>, by blocks: a fold copies what it has gathered at every
    step, so it gathers at most a block, and then the blocks' totals."""
    a, x, b, v = (_name(k) for k in "axbv")
    empty = "named_struct('d', 0, 'o', CAST(array() AS array<int>))"

    def blocks(ns):
        fold = f"({a}, {x}) -> named_struct('d', {a}.d + {x}, 'o', concat({a}.o, array({a}.d + {x})))"
        return f"transform(sequence(0, CAST((size({ns}) - 1) DIV {_RUN} AS INT)), {b} -> aggregate(slice({ns}, {b} * {_RUN} + 1, {_RUN}), {empty}, {fold}))"

    def joined(bs):
        before = f"aggregate({bs}, {empty}, ({a}, {x}) -> named_struct('d', {a}.d + {x}.d, 'o', concat({a}.o, array({a}.d))), {a} -> {a}.o)"
        return let(before, lambda o: f"flatten(transform({bs}, ({x}, {b}) -> transform({x}.o, {v} -> {v} + {o}[{b}])))")
    return let(numbers, lambda ns: let(blocks(ns), joined))


def outline(h: str) -> str:
    """SQL: every element of the TAG_NAMES in document order, from one pass over the markup: where its opening tag
    begins (pos), its name, that tag, its depth among elements of its name (1 = outermost), where its inner markup
    begins (s) and ends (e), and where the closing tag ends (f).  An element that nothing closes ends with the markup.

    Sorted by (level, place), the tags of one name alternate between an opening tag and the closing one that
    belongs to it, as the depth passes a level up and down in turn; so an element's end is its neighbour there.
    """
    t, i, x, y, k = (_name(v) for v in "tixyk")

    def matched(tags, end):
        def by_level(d):
            return (f"array_sort(transform({tags}, ({y}, {k}) -> named_struct('l', {d}[{k}] + CASE WHEN {y}.c THEN 1 ELSE 0 END, "
                    f"'z', {y}.z, 'c', {y}.c, 'n', {y}.n, 't', {y}.t)))")

        def pairs(o):
            nxt = f"get({o}, {k} + 1)"
            closed = f"{nxt}.l <=> {y}.l"
            return (f"transform(filter(transform({o}, ({y}, {k}) -> named_struct('c', {y}.c, 'x', named_struct('pos', {y}.z - length({y}.t), 'n', {y}.n, 't', {y}.t, 'd', {y}.l, 's', {y}.z, "
                    f"'e', CASE WHEN {closed} THEN {nxt}.z - length({nxt}.t) ELSE {end} END, 'f', CASE WHEN {closed} THEN {nxt}.z ELSE {end} END))), {y} -> NOT {y}.c), {y} -> {y}.x)")
        depth = _running(f"transform({tags}, {y} -> CASE WHEN {y}.c THEN -1 ELSE 1 END)")
        return f"CASE WHEN size({tags}) = 0 THEN CAST(array() AS {_ELEMENTS}) ELSE {let(let(depth, by_level), pairs)} END"

    def placed(s, end):
        ends = _running(f"transform({s}.m, ({t}, {i}) -> length({t}) + length({s}.g[{i}]))")
        tags = let(ends, lambda z: (f"transform({s}.m, ({t}, {i}) -> named_struct('z', {z}[{i}], 'c', startswith({t}, '</'), "
                                    f"'n', lower(regexp_extract({t}, '([A-Za-z0-9]+)', 1)), 't', {t}))"))
        names = ", ".join(f"'{n}'" for n in TAG_NAMES)
        every = let(tags, lambda ts: f"flatten(transform(array({names}), {x} -> {let(f'filter({ts}, {y} -> {y}.n = {x})', lambda one: matched(one, end))}))")
        return f"CASE WHEN size({s}.m) = 0 THEN CAST(array() AS {_ELEMENTS}) ELSE array_sort({every}) END"
    return let(h, lambda v: let(f"named_struct('m', regexp_extract_all({v}, {_TAG}, 0), 'g', split({v}, {_TAG}, -1))", lambda s: placed(s, f"length({v})")))


def _outlined(h: str, tags: str | None, body) -> str:
    """SQL: body(markup, outline), with the outline made here unless ``tags`` names one."""
    return body(h, tags) if tags else let(h, lambda v: let(outline(v), lambda o: body(v, o)))


def _chosen(o: str, tag: str, wanted: str) -> str:
    x = _name("x")
    return f"filter({o}, {x} -> {x}.n = '{tag}' AND ({wanted.format(t=f'{x}.t', d=f'{x}.d')}))"


def elements(h: str, tag: str, wanted: str, tags: str | None = None) -> str:
    """SQL: array<struct<pos int, html string>> of the elements ``tag`` in document order, with their inner
    markup.  ``wanted`` is a condition on the opening tag {t} and its depth {d} (1 = outermost); ``tags`` is
    the outline of the markup, where it stands in a column."""
    x = _name("x")
    return _outlined(h, tags, lambda v, o: f"transform({_chosen(o, tag, wanted)}, {x} -> struct({x}.pos AS pos, substring({v}, {x}.s + 1, {x}.e - {x}.s) AS html))")


def without(h: str, tag: str, wanted: str, tags: str | None = None) -> str:
    """SQL: the markup without the elements ``tag`` whose opening tag {t} satisfies ``wanted``."""
    a, x, y = (_name(v) for v in "axy")

    def body(v, o):
        def kept(gone):
            outer = f"filter({gone}, {x} -> NOT exists({gone}, {y} -> {y}.pos < {x}.pos AND {x}.f <= {y}.f))"
            return (f"aggregate({outer}, named_struct('at', 0, 'o', ''), ({a}, {x}) -> named_struct('at', {x}.f, 'o', concat({a}.o, substring({v}, {a}.at + 1, {x}.pos - {a}.at))), "
                    f"{a} -> concat({a}.o, substring({v}, {a}.at + 1)))")
        return let(_chosen(o, tag, wanted), kept)
    return _outlined(h, tags, body)


def has(attribute: str) -> str:
    """SQL condition for ``elements``: the opening tag carries the attribute."""
    return f"contains({{t}}, '{attribute}')"


ARTICLE, FEED, AUTO = has('role="article"'), has('role="feed"'), has('dir="auto"')


class Markup(NamedTuple):
    """SQL names of a unit's markup, its outline, the markup without nested replies and that one's outline; an
    outline of None is made anew by each extraction."""
    html: str
    tags: str | None
    own: str
    own_tags: str | None


def markup(h: str | Markup) -> Markup:
    return h if isinstance(h, Markup) else Markup(h, None, own_markup(h), None)


#: the columns of ``with_markup``
SHARED = Markup("html", "_tags", "_own", "_own_tags")


def with_markup(units: DataFrame) -> DataFrame:
    """Units with the columns SHARED: every extraction of a unit reads one outline."""
    return (units.withColumn("_tags", F.expr(outline("html"))).withColumn("_own", F.expr(own_markup("html", "_tags")))
            .withColumn("_own_tags", F.expr(outline("_own"))))


def page_parts(h: str = "html") -> str:
    """SQL: A10, array<struct<kind, unit_pos, html>>: the direct children of the page's feed, and every article
    element, nested ones too; each kind in document order."""
    x, k = _name("x"), _name("k")

    def units(v, o):
        def part(kind, found):
            return f"transform({found}, ({x}, {k}) -> struct('{kind}' AS kind, {k} AS unit_pos, substring({v}, {x}.s + 1, {x}.e - {x}.s) AS html))"
        inside = let(f"get({_chosen(o, 'div', FEED)}, 0)", lambda f: f"filter({o}, {x} -> {x}.n = 'div' AND {x}.d = {f}.d + 1 AND {x}.pos >= {f}.s AND {x}.pos < {f}.e)")
        return f"concat({part('feed', inside)}, {part('article', _chosen(o, 'div', ARTICLE))})"
    return _outlined(h, None, units)


def own_markup(h: str = "html", tags: str | None = None) -> str:
    """SQL: a unit without its nested replies."""
    return without(h, "div", ARTICLE, tags)


def visible_text(html) -> Column:
    """Line breaks at ``<br>`` and at the ends of blocks only, other tags removed, common entities decoded."""
    x = F.regexp_replace(col_(html), r"(?is)<script\b.*?</script>|<style\b.*?</style>", "")
    x = F.regexp_replace(x, r"(?i)<br\s*/?>|</(?:div|p|li|h[1-6])>", "\n")
    x = F.regexp_replace(x, r"<[^>]*>", "")
    x = decode_entities(x)
    return F.regexp_replace(x, r"\n{3,}", "\n\n")


def content_text(html) -> Column:
    """All text of a node, as it stands in the markup."""
    return decode_entities(F.regexp_replace(col_(html), r"<[^>]*>", ""))


def _in_order(*arrays: str) -> Column:
    """Elements of several searches in document order: array<string> of their markup."""
    return F.transform(F.array_sort(F.concat(*[F.expr(a) for a in arrays])), lambda e: e["html"])


def links(html) -> Column:
    """Ordered array of ``struct(href, txt)`` for every ``<a href=...>text</a>``."""
    h = col_(html)
    hrefs = F.regexp_extract_all(h, F.lit(r'(?is)<a\b[^>]*?href="([^"]*)"[^>]*>.*?</a>'), 1)
    texts = F.regexp_extract_all(h, F.lit(r'(?is)<a\b[^>]*?href="[^"]*"[^>]*>(.*?)</a>'), 1)
    return F.arrays_zip(F.transform(hrefs, lambda x: decode_entities(x)).alias("href"),
                        F.transform(texts, lambda t: py_strip(decode_entities(F.regexp_replace(t, "<[^>]*>", "")))).alias("txt"))


def _is_post_link(href: Column) -> Column:
    return (href.contains("/posts/") | href.contains("/permalink.php")) & ~href.contains("comment_id=")


def _is_comment_link(href: Column) -> Column:
    return href.contains("/posts/") & href.contains("comment_id=")


# ---------------------------------------------------------------- C7-C10
def _line_count(lines: Column, pattern: str) -> Column:
    def clean(l):
        return py_strip(F.regexp_replace(py_strip(l), "^[" + BIDI_MARKS + "]+|[" + BIDI_MARKS + "]+$", ""))
    cand = F.filter(F.transform(lines, clean), lambda l: (l != "") & (F.length(l) <= LINE_MAX_CHARS)
                    & l.rlike(r"^[\d٠-٩]") & ~_any(F.lower(l), ENGAGEMENT_SKIP_WORDS))
    got = F.transform(cand, lambda l: F.regexp_extract(l, "(?U)" + pattern, 1))
    val = first(F.filter(got, lambda v: v != ""))
    v = F.regexp_replace(F.replace(val, F.lit(" "), F.lit("")), r"[.,]+$", "")
    return F.coalesce(F.translate(v, ARABIC_DIGITS, ASCII_DIGITS), F.lit(""))


def engagement_from_lines(text) -> tuple[Column, Column]:
    """(comments, shares) from short number-leading lines, first hit per field."""
    lines = F.split(col_(text), "\n")
    return _line_count(lines, LINE_COMMENTS), _line_count(lines, LINE_SHARES)


def _node_count(nodes: Column, pattern: str) -> Column:
    cand = F.filter(nodes, lambda t: (t != "") & (F.length(t) <= NODE_MAX_CHARS))
    got = F.transform(cand, lambda t: F.regexp_extract(t, "(?iU)" + pattern, 1))
    val = first(F.filter(got, lambda v: v != ""))
    return F.coalesce(F.translate(F.regexp_replace(val, r"\s+", ""), ARABIC_DIGITS, ASCII_DIGITS), F.lit(""))


def anchored_counts(h: str | Markup = "html") -> tuple[Column, Column]:
    """Span, link and button nodes whose whole text is a count (<= 25 chars), nested replies excluded."""
    m = markup(h)
    button = 'contains({t}, \'role="button"\') OR contains({t}, \'role="link"\')'
    nodes = F.transform(_in_order(*[elements(m.own, tag, wanted, m.own_tags) for tag, wanted in (("span", "true"), ("a", "true"), ("div", button))]),
                        lambda t: py_strip(F.translate(content_text(t), BIDI_MARKS, "")))
    return _node_count(nodes, NODE_COMMENTS), _node_count(nodes, NODE_SHARES)


def line_counts(h: str | Markup = "html") -> tuple[Column, Column]:
    """C7 over a unit's own text."""
    return engagement_from_lines(visible_text(F.expr(markup(h).own)))


def engagement_counts(h: str | Markup = "html") -> tuple[Column, Column]:
    """Anchored counts, each field falling back to the line parser."""
    (ac, as_), (lc, ls) = anchored_counts(h), line_counts(h)
    return F.when(ac != "", ac).otherwise(lc), F.when(as_ != "", as_).otherwise(ls)


def reaction_count(h: str | Markup = "html", fallback: bool = False) -> Column:
    """First number inside an ``aria-label`` that mentions like/react (en/ar); with ``fallback``
    (articles) else the first hidden span that is a bare number."""
    m = markup(h)
    labels = F.regexp_extract_all(F.expr(m.html), F.lit(r'aria-label="([^"]*)"'), 1)
    hit = F.filter(labels, lambda a: _any(F.lower(a), REACTION_WORDS) | _any(a, REACTION_WORDS_AR))
    nums = F.filter(F.transform(hit, lambda a: F.regexp_extract(a, REACTION_NUMBER, 1)), lambda v: v != "")
    v = F.replace(first(nums), F.lit(" "), F.lit(""))
    if fallback:
        hidden = F.transform(F.expr(elements(m.html, "span", has('aria-hidden="true"'), m.tags)), lambda e: py_strip(content_text(e["html"])))
        v = F.coalesce(v, first(F.filter(hidden, lambda t: t.rlike(r"^[\d,٠-٩\.]+[KkMm]?$"))))
    return F.coalesce(F.translate(v, ARABIC_DIGITS, ASCII_DIGITS), F.lit(""))


# ---------------------------------------------------------------- C13, C17, C18
def _named(lk: Column, hosts: list[str]) -> Column:
    ok = F.filter(lk, lambda l: (F.length(l["txt"]) > 2) & (F.length(l["txt"]) < 60)
                  & ~_any(F.lower(l["txt"]), BAD_AUTHOR_WORDS)
                  & ~l["href"].contains("/posts/") & ~l["href"].contains("/permalink.php")
                  & ~l["txt"].contains("?") & ~l["txt"].contains(":")
                  & _any(l["href"], hosts))
    return first(ok)["txt"]


def author_from_links(h: str | Markup = "html") -> Column:
    """A link in a profile-name element or a heading (3..59 chars, not a post link); else the first
    link of the unit that passes the name rules."""
    name = has('data-ad-rendering-role="profile_name"')
    m = markup(h)
    heads = _in_order(*[elements(m.html, tag, wanted, m.tags) for tag, wanted in (("div", name), ("span", name), ("h2", "true"), ("h3", "true"))])
    head = F.flatten(F.transform(heads, links))
    ok_head = F.filter(head, lambda l: (F.length(l["txt"]) > 2) & (F.length(l["txt"]) < 60) & ~l["href"].contains("/posts/"))
    return F.coalesce(first(ok_head)["txt"], _named(links(F.expr(m.html)), AUTHOR_LINK_HOSTS), F.lit(""))


def article_author(h: str = "html") -> Column:
    """C13 for article units: the first link that passes the name rules, with fewer hosts."""
    return F.coalesce(_named(links(F.expr(h)), ARTICLE_AUTHOR_HOSTS), F.lit(""))


def permalink(html, group_id: str) -> Column:
    """C17: first clean post link; else the first comment link that has a base or a post id."""
    lk = links(html)
    clean = first(F.filter(lk, lambda l: _is_post_link(l["href"])))["href"]

    def base(l):
        pid = F.nullif(F.regexp_extract(l["href"], r"/posts/(\d+)", 1), F.lit(""))
        built = F.concat(F.lit(f"https://www.facebook.com/groups/{group_id}/posts/"), pid, F.lit("/"))
        return F.coalesce(F.nullif(F.regexp_extract(l["href"], COMMENT_BASE, 1), F.lit("")), built)
    from_comment = first(F.filter(F.transform(F.filter(lk, lambda l: _is_comment_link(l["href"])), base), lambda u: u.isNotNull()))
    return F.coalesce(clean, from_comment, F.lit(""))


def time_label(html) -> Column:
    """Text of the clean post link when short and not a share/host word."""
    lk = links(html)
    t = first(F.filter(lk, lambda l: _is_post_link(l["href"])))["txt"]
    ok = (F.length(t) > 0) & (F.length(t) < TIMESTAMP_MAX_CHARS) & ~_any(F.lower(t), TIMESTAMP_BAD_WORDS)
    return F.when(ok, t).otherwise(F.lit(""))


def image_urls(html) -> Column:
    """Kept image URLs, distinct, in document order."""
    srcs = F.transform(F.regexp_extract_all(col_(html), F.lit(r'(?i)<img\b[^>]*?src="([^"]*)"'), 1), decode_entities)
    keep = F.filter(srcs, lambda s: s.contains(IMAGE_HOST_MARK) & ~_any(s, IMAGE_EXCLUDE) & s.contains(IMAGE_CDN_MARK))
    return F.array_distinct(keep)


# ---------------------------------------------------------------- C20-C22, B6, B7
def _longest(blocks: Column, over: int) -> Column:
    """The longest text of more than ``over`` characters, the first of equals; '' without one."""
    return F.aggregate(blocks, F.lit(""), lambda acc, b: F.when((F.length(b) > F.length(acc)) & (F.length(b) > over), b).otherwise(acc))


def _texts(sql: str) -> Column:
    return F.transform(F.expr(sql), lambda e: py_strip(visible_text(e["html"])))


def body_text(h: str | Markup = "html") -> Column:
    """C20: longest ``dir="auto"`` block (> 5 chars), else such a span, else the whole text of the unit without
    its replies; a result under 10 characters gives way to a longer message block."""
    m = markup(h)
    block, span = (_longest(_texts(elements(m.own, tag, AUTO, m.own_tags)), BODY_MIN_CHARS) for tag in ("div", "span"))
    body = F.when(block != "", block).when(span != "", span).otherwise(py_strip(visible_text(F.expr(m.own))))
    mark = " OR ".join(f"contains({{t}}, '{x}')" for x in MESSAGE_MARKS)
    message = _longest(_texts(elements(m.html, "div", mark, m.tags)), 0)
    return F.when((F.length(body) < BODY_SHORT) & (F.length(message) > F.length(body)), message).otherwise(body)


def is_comment(html) -> Column:
    """Post-vs-comment decision for an article unit."""
    h = col_(html)
    lk = links(h)
    has_post = F.exists(lk, lambda l: _is_post_link(l["href"]))
    has_com = F.exists(lk, lambda l: (l["href"].contains("/posts/") | l["href"].contains("/permalink.php"))
                       & l["href"].contains("comment_id="))
    txt = visible_text(h)
    reply = txt.rlike(r"(?U)\bReply\b") | txt.rlike(r"(?U)ردّ?\b")
    comment_word = txt.rlike(r"(?U)\bComment\b") | txt.contains("تعليق")
    n = F.length(h)
    return (F.when(has_post, F.lit(False)).when(has_com, F.lit(True))
            .when(n < COMMENT_MAX_HTML, F.lit(True))
            .when(reply & ~comment_word, F.lit(True))
            .when(comment_word & (n > POST_MIN_HTML), F.lit(False))
            .otherwise(F.lit(False)))


def harvested_post_ids(html) -> Column:
    """Distinct post ids of all clean ``/posts/`` links on a page, in order."""
    hrefs = F.transform(F.regexp_extract_all(col_(html), F.lit(r'(?i)<a\b[^>]*?href="([^"]*)"'), 1), decode_entities)
    clean = F.filter(hrefs, lambda x: x.contains("/posts/") & ~x.contains("comment_id="))
    return F.array_distinct(F.filter(F.transform(clean, lambda x: F.regexp_extract(x, r"/posts/(\d+)", 1)), lambda v: v != ""))


def post_links(h: str = "html") -> str:
    """SQL: array<struct<post_id string, href string, html string>> of the clean ``/posts/`` links of a page, the
    first of each post id, in order, with the inner markup of their container: the nearest enclosing article, else
    the nearest of the 4th to 7th enclosing divs that is over 5000 characters; NULL without one."""
    low, high = CONTAINER_LEVELS

    def body(m, g, d):
        k, x, r, l, a, i, e, c = (_name(v) for v in "kxrlaiec")
        n = f"size({m})"
        # the texts between div tags hold the links; text k follows tag k - 1
        found = (f"flatten(transform(sequence(0, {n}), {k} -> transform(filter(regexp_extract_all({g}[{k}], '(?is)<a\\\\b[^>]*?href=\"([^\"]*)\"', 1), "
                 f"{x} -> contains({x}, '/posts/') AND NOT contains({x}, 'comment_id=')), {x} -> struct(regexp_extract({x}, '/posts/([0-9]+)', 1) AS id, {x} AS href, {k} AS k))))")
        # back from the link, the first opening tag of each lower depth encloses it
        def above(l):
            step = f"NOT startswith({m}[{i}], '</') AND {d}[{i}] = {a}.d"
            return (f"CASE WHEN {l}.k = 0 THEN CAST(array() AS array<int>) ELSE aggregate(sequence({l}.k - 1, 0, -1), named_struct('d', {d}[{l}.k - 1], 'o', CAST(array() AS array<int>)), "
                    f"({a}, {i}) -> named_struct('d', {a}.d - CASE WHEN {step} THEN 1 ELSE 0 END, 'o', CASE WHEN {step} THEN concat({a}.o, array({i})) ELSE {a}.o END), {a} -> {a}.o) END")

        def inner(i):
            return let(_ends(d, i, n), lambda e: f"concat({g}[{i} + 1], array_join(transform(filter(sequence(0, {n} - 1), {k} -> {k} > {i} AND {k} < {e}), {k} -> concat({m}[{k}], {g}[{k} + 1])), ''))")

        def container(up):
            article = f"get(filter({up}, {i} -> {ARTICLE.format(t=f'{m}[{i}]')}), 0)"
            large = f"get(filter(transform(slice({up}, {low}, {high - low + 1}), {i} -> {inner(i)}), {x} -> length({x}) > {CONTAINER_MIN_HTML}), 0)"
            return let(article, lambda q: f"CASE WHEN {q} IS NOT NULL THEN {inner(q)} ELSE {large} END")

        def posts(fs):
            firsts = f"transform(array_distinct(filter(transform({fs}, {r} -> {r}.id), {r} -> {r} <> '')), {c} -> get(filter({fs}, {r} -> {r}.id = {c}), 0))"
            return f"transform({firsts}, {l} -> struct({l}.id AS post_id, {l}.href AS href, {let(above(l), container)} AS html))"
        return let(found, posts)
    return _cut(h, "div", body)


def is_skeleton(html) -> Column:
    """Placeholder unit: under 1500 chars of HTML and no link."""
    return (F.length(col_(html)) < SKELETON_MAX_HTML) & ~col_(html).rlike(r"(?i)<a[\s>]")


def big_enough(html) -> Column:
    """Article units under 2000 chars of HTML are skipped."""
    return F.length(col_(html)) >= ARTICLE_MIN_HTML
