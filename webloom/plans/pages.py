"""Queries over web pages: facts of a page, its design, and the records rendered from it."""

from __future__ import annotations

from ..functions import values as v
from ..functions.dialect import Spark, any_of, choose, strip, times
from ..functions.entities import unescaped

#: Longer pages yield no examples.
LONGEST_PAGE = 5_000_000
IMAGE_URL = r"(?i)url\([\x22\x27]?[^\x22\x27)]+\.(jpg|jpeg|png|gif|webp|svg)[\x22\x27]?\)"


def facts(d: Spark, own: bool = False) -> str:
    """page_id, url, html, title, css (cleaned), js, and the lower-cased text that classifiers search.

    Also shown, the markup that examples show, and told, the text that tells the industry: html and title, or pages' own,
    then with their categories and number of sheets.
    """
    css = d.join(d.keep(d.find_all("html", r"(?is)<style[^>]*>(.*?)</style>"), d.matches("x", r"\S")), "\n\n")
    js = d.join(d.find_all("html", r"(?is)<script[^>]*>(.*?)</script>"), "\n\n")
    cleaned = strip(d, d.sub(d.sub(css, IMAGE_URL, "url(https://picsum.photos/800/600)"), r"\n\s*\n", "\n\n"))
    title = strip(d, d.find("html", r"(?is)<title[^>]*>(.*?)</title>"))
    told = "shown, told, category, n_css" if own else f"html AS shown, {title} AS told"
    return f"(SELECT page_id, url, html, {told}, {title} AS title, {cleaned} AS css, {js} AS js, lower(concat_ws(' ', {css}, html)) AS combined FROM pages)"


def keywords(d: Spark, x: str = "combined") -> str:
    return d.first_of([f"CASE WHEN {any_of(x, words)} THEN '{label}' END" for words, label in v.DESIGN_KEYWORDS], 8)


def industry(x: str) -> str:
    return choose([(any_of(x, words), name) for words, name in v.INDUSTRIES], "''")


def scheme(d: Spark, own: bool = False) -> str:
    """Top colours and colour scheme of each page's stylesheet: tokens by count, then by pattern and place."""
    patterns = ((r"(?i)color:\s*([#\w]+)", 1), (r"(?i)background(?:-color)?:\s*([#\w]+)", 1), (r"#[0-9a-fA-F]{3,6}", 0), (r"(?i)rgb\([^)]+\)", 0), (r"(?i)rgba\([^)]+\)", 0))
    found = d.tagged("f", [d.find_all("css", p, g) for p, g in patterns])
    return f"""f AS {facts(d, own)},
        tokens AS (SELECT page_id, pattern, nth, lower(token) AS token FROM {found} t),
        counted AS (SELECT page_id, token, count(*) AS n, min(pattern * 1000000 + nth) AS first_at FROM tokens WHERE length(token) > 2 GROUP BY page_id, token),
        top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY n DESC, first_at) AS place FROM counted) c WHERE place <= 3),
        schemes AS (SELECT page_id, CASE WHEN max(CASE WHEN {any_of('token', ('dark', 'black'))} THEN 1 ELSE 0 END) = 1 THEN 'Dark' WHEN max(CASE WHEN {any_of('token', ('light', 'white'))} THEN 1 ELSE 0 END) = 1 THEN 'Light' ELSE 'Mixed' END AS color_scheme FROM top GROUP BY page_id)"""


def characteristics(d: Spark, own: bool = False) -> str:
    """CTEs that end in ch: a row of design characteristics for each page."""
    c, css = "combined", "lower(css)"
    motion = choose([(any_of(c, ("three.js", "webgl", "babylon")), "Advanced 3D animations"), (any_of(c, ("gsap", "anime.js", "framer", "lottie", "aos")), "Subtle animations"), (any_of(css, ("transition", "animation", "transform")), "CSS animations")], "'None'")
    layout = choose([(any_of(css, ("display: grid", "display:grid", "grid-template")), "Grid-based"), (any_of(css, ("display: flex", "display:flex", "flexbox")), "Flex-based"), (any_of(c, ("bootstrap", "foundation")), "Framework-based")], "'Standard'")
    images = " + ".join(times("lower(html)", w) for w in ("<img", "background-image", "background: url"))
    events = " + ".join(times("lower(js)", w) for w in ("addeventlistener", "onclick", "on("))
    stack = choose([(any_of(c, ("react", "vue", "angular", "svelte")), "Modern Framework"), (any_of(c, ("jquery",)), "HTML + CSS + JS + jQuery"), (any_of(c, ("typescript", ".ts")), "HTML + CSS + TypeScript")], "'HTML + CSS + JS'")
    fonts = choose([(any_of(css, ("googleapis", "fonts.com", "typekit", "adobe fonts")), "Custom web fonts"), (any_of(css, ("font-family",)), "Custom typography")], "'Standard'")
    tone = choose([(f"industry = '{name}'", t) for name, t in v.INDUSTRY_TONES] + [(any_of("lower(told)", words), t) for words, t in v.CATEGORY_TONES if own] + [(any_of(c, words), t) for words, t in v.WORD_TONES], "'Professional'")
    return f"""{scheme(d, own)},
        g AS (SELECT *, {industry('told')} AS industry, {images} AS images, {events} AS events FROM f),
        ch AS (SELECT g.*, {tone} AS tone, {layout} AS layout, CASE WHEN images > 30 THEN 'Very High' WHEN images > 20 THEN 'High' WHEN images < 5 THEN 'Low' ELSE 'Medium' END AS photo_usage,
            {motion} AS motion, {stack} AS stack, (contains(html, 'viewport') OR contains({css}, '@media') OR contains({c}, 'responsive')) AS responsive,
            CASE WHEN {any_of('html', ('aria-', 'role=', 'alt='))} THEN 'Enhanced' ELSE 'Standard' END AS accessibility, coalesce(color_scheme, 'Mixed') AS scheme, {fonts} AS typography,
            CASE WHEN events > 10 THEN 'High' WHEN events > 5 THEN 'Medium' ELSE 'Low' END AS interactivity, {d.join(keywords(d), ', ')} AS keywords
            FROM g LEFT JOIN schemes ON g.page_id = schemes.page_id)"""


def lines(*parts: str) -> str:
    """Lines joined by newlines, without those that are null."""
    return f"concat_ws('\n', {', '.join(parts)})"


def page_parts(d: Spark, own: bool = False) -> str:
    """CTEs that end in parts: instruction, reasoning and code of each page that isn't empty or too long, and what tells its design."""
    t = d.text
    html = f"CASE WHEN length(shown) > 1000000 THEN concat(substring(shown, 1, 1000000), {t(chr(10) + '<!-- ... rest of HTML ... -->')}) ELSE shown END"
    instruction = lines(
        "CASE WHEN industry <> '' THEN concat('Industry: ', industry) END", "concat('Brand tone: ', tone)", "concat('Layout style: ', layout)",
        "CASE WHEN responsive THEN 'Requirements: Responsive design (mobile-first)' END", "concat('Color scheme: ', scheme)", "concat('Image usage: ', photo_usage, ' (use placeholder images)')",
        "CASE WHEN motion <> 'None' THEN concat('Interactions: ', motion) END", "CASE WHEN keywords <> '' THEN concat('Design style: ', keywords) END", t(v.PAGE_TASK),
    )
    reasoning = lines(
        "concat('- Layout structure: ', layout, ' layout approach for optimal information hierarchy and user experience')", "concat('- Visual design: ', tone, ' brand tone with ', scheme, ' color palette')",
        "CASE WHEN keywords <> '' THEN concat('- Design features: ', keywords) END", "CASE WHEN responsive THEN '- Responsive design: Mobile-first approach with flexible grid system and breakpoints' END",
        "CASE WHEN motion <> 'None' THEN concat('- Interactions: ', motion, ' for enhanced user engagement') END", "concat('- Visual content: ', photo_usage, ' imagery to support brand message')",
    )
    code = lines(t("\nCode:"), "'```html'", html, "'```'", f"CASE WHEN css <> '' THEN concat({t(chr(10) + '```css' + chr(10) + '/* inline */' + chr(10))}, css, {t(chr(10) + '```')}) END")
    told = "industry, tone, layout, photo_usage, motion, scheme, stack, keywords" + (", category, n_css" if own else "")
    return f"{characteristics(d, own)}, parts AS (SELECT page_id, {told}, {instruction} AS instruction, {reasoning} AS reasoning, {code} AS code FROM ch WHERE html <> '' AND length(html) <= {LONGEST_PAGE})"


def full_page_examples(d: Spark, own: bool = False) -> str:
    """An example of each page that isn't empty or too long."""
    output = lines("'Design reasoning:'", "reasoning", "code")
    return f"WITH {page_parts(d, own)}, ex AS (SELECT page_id, instruction, {output} AS output FROM parts) SELECT page_id, instruction, output FROM ex WHERE length(instruction) >= 50 AND length(output) >= 100 AND contains(output, '```')"


def page_characteristics(d: Spark) -> str:
    return f"WITH {characteristics(d)} SELECT page_id, tone, layout, photo_usage, motion, stack, responsive, accessibility, scheme AS color_scheme, typography, interactivity FROM ch"


def design_keywords(d: Spark) -> str:
    return f"WITH f AS {facts(d)} SELECT page_id, {d.join(keywords(d), ', ')} AS keywords FROM f"


def page_titles(d: Spark) -> str:
    """Title and description of a page; the description in either order of a meta's attributes, and in either kind of quotes."""
    name = r"name=[\x22\x27]?description[\x22\x27\s/>]"
    after = [rf"(?is)<meta\s(?:[^>]*\s)?{name}[^>]*?content={q}([^{q}]*){q}" for q in (r"\x22", r"\x27")]
    before = [rf"(?is)<meta\s(?:[^>]*\s)?content={q}([^{q}]*){q}[^>]*\s{name}" for q in (r"\x22", r"\x27")]
    described = ", ".join(f"nullif({d.find('html', p)}, '')" for p in after + before)
    return f"WITH f AS {facts(d)}, m AS (SELECT page_id, title, coalesce({described}, CASE WHEN html IS NOT NULL THEN '' END) AS described FROM f) SELECT page_id, {strip(d, unescaped(d, 'title'))} AS title, {unescaped(d, 'described')} AS description FROM m"


def script_urls(d: Spark) -> str:
    """page_id, nth, href, script_url: what each script with a source names, and where that is, from the host of the page."""
    sources = d.exploded("pages", d.find_all("html", r"(?i)<script\s(?:[^>]*\s)?src\s*=\s*[\x22\x27]?([^\x22\x27\s>]+)"), "nth", "href", "page_id, url")
    return f"SELECT page_id, nth, href, {absolute(d)} AS script_url FROM {sources} x"


def inline_css(d: Spark) -> str:
    return f"WITH f AS {facts(d)} SELECT page_id, css FROM f WHERE css <> ''"


def inline_js(d: Spark) -> str:
    """Scripts without src, over `> 50` characters in the corpus build; here all, spaced out."""
    spaced = d.sub(d.sub("script", ";", ";\n"), r"\s*\{", " {\n")
    return f"SELECT page_id, nth AS ordinal, {spaced} AS script, length(script) > 50 AS kept FROM {d.exploded('pages', d.find_all('html', r'(?is)<script>(.*?)</script>'), 'nth', 'script', 'page_id')} t"


def minified_flag(d: Spark) -> str:
    """Obfuscated or minified code, by its patterns, mean line length and share of line breaks."""
    patterns = r"(?i)_0x[a-f0-9]+", r"[a-z]\s*=\s*[\x22\x27][a-z]{1,3}[\x22\x27]", r"eval\s*\(", r"atob\s*\(", r"String\.fromCharCode", r"\\x[0-9a-f]{2}"
    odd = " OR ".join(d.matches("code", p) for p in patterns)
    built = any_of("lower(code)", v.BUILD_MARKS)
    nonblank = d.keep(d.split("code", "\n"), d.matches("x", r"\S"))
    size = "size(lines)" if d.name == "spark" else "len(lines)"
    return f"""WITH c AS (SELECT page_id, {d.join(d.find_all('html', r'(?is)<script[^>]*>(.*?)</script>'), chr(10))} AS code FROM pages),
        l AS (SELECT page_id, code, {nonblank} AS lines FROM c),
        m AS (SELECT page_id, code, CAST({size} AS DOUBLE) AS n, CAST(length({d.join('lines', '')}) AS DOUBLE) AS chars FROM l)
        SELECT page_id, length({strip(d, 'code')}) >= 50 AND ({odd} OR (chars / nullif(n, 0) > 500 AND n / nullif(length(code), 0) < 0.01) OR (chars / nullif(n, 0) > 200 AND {d.matches('code', r'[a-z]\{[a-z]|[a-z]\}[a-z]')}) OR (chars / nullif(n, 0) > 200 AND {built})) AS minified FROM m"""


def visible_text(d: Spark) -> str:
    bare = "html"
    for tag in ("script", "style", "noscript"):  # each ends at its own end alone
        bare = d.sub(bare, rf"(?is)<{tag}(\s[^>]*)?>.*?</{tag}>", " ")
    bare = d.sub(bare, r"(?s)<!--.*?-->|<[^>]*>", " ")
    clean = strip(d, d.sub(f"replace({unescaped(d, 'bare')}, '\u00a0', ' ')", r"\s+", " "))
    return f"WITH b AS (SELECT page_id, {bare} AS bare FROM pages), t AS (SELECT page_id, {clean} AS t FROM b) SELECT page_id, CASE WHEN length(t) > 5000 THEN concat(substring(t, 1, 5000), '...') ELSE t END AS text FROM t"


def strip_comment_artifacts(d: Spark) -> str:
    """Without the mark of saved pages and what broken comments leave; the last two patterns may take text before a stray end."""
    x = d.sub("html", r"<!-- saved from url=[^>]*-->", "")
    for pattern in (r"<!--\s*-->", r"<!--\s*<!--[^>]*-->", r"<!--[^>]*-->\s*<!--", r"(?m)<!--[^>]*$", r"(?m)^[^<]*-->"):
        x = d.sub(x, pattern, "")
    return f"SELECT page_id, {x} AS html FROM pages"


def doctype_charset(d: Spark) -> str:
    """The doctype and a charset, put in where they are missing."""
    legacy = d.sub("html", r"(?i)<meta[^>]*http-equiv=[\x22\x27]?content-type[^>]*>", "")
    meta = '<meta charset="utf-8">'
    first = lambda pattern, more: d.sub("h", rf"(?is)^(.*?{pattern})", d.back(1) + more)
    headed, rooted = r"<head(?:\s[^>]*)?>", r"<html(?:\s[^>]*)?>"
    head = f"CASE WHEN {d.matches('h', '(?i)' + headed)} THEN {first(headed, meta)} WHEN {d.matches('h', '(?i)' + rooted)} THEN {first(rooted, f'<head>{meta}</head>')} ELSE concat('<head>{meta}</head>', h) END"
    return f"""WITH a AS (SELECT page_id, {legacy} AS h FROM pages), b AS (SELECT page_id, CASE WHEN {d.matches('h', r'(?i)<meta[^>]*charset')} THEN h ELSE {head} END AS h FROM a)
        SELECT page_id, CASE WHEN starts_with_doctype THEN h ELSE concat('<!DOCTYPE html>\n', h) END AS html FROM (SELECT page_id, h, substring(h, 1, 9) IN ('<!DOCTYPE', '<!doctype') AS starts_with_doctype FROM b) c"""


def sanitize_url(d: Spark) -> str:
    bare = "replace(replace(url, 'https://', ''), 'http://', '')"
    return f"SELECT page_id, {d.sub(d.sub(bare, r'[<>:\x22|?*]', '_'), r'/+$', '')} AS folder FROM pages"


def host(d: Spark, x: str) -> str:
    return d.find(x, r"^[^:]+://([^/?#]*)")


def base_domain(d: Spark) -> str:
    return f"SELECT page_id, {host(d, 'url')} AS host, {d.sub(host(d, 'url'), r'^www\.', '')} AS base_domain FROM pages"


def asset_filename(d: Spark) -> str:
    path = d.find("url", r"^[^:]+://[^/?#]*([^?#]*)")
    return f"""WITH p AS (SELECT page_id, {d.last_part(path, '/')} AS name FROM pages)
        SELECT page_id, CASE WHEN name = '' THEN concat('style_', page_id, '.css') WHEN {d.matches('name', r'\.css$')} THEN name ELSE concat(name, '.css') END AS css_name,
               CASE WHEN {d.matches('name', r'(?i)\.(jpg|jpeg|png|gif|webp|svg)$')} THEN name WHEN name = '' THEN concat('image_', page_id, '.jpg') ELSE concat(name, '.jpg') END AS image_name FROM p"""


def links(d: Spark) -> str:
    """page_id, url, nth, href, label of each anchor."""
    anchors = d.exploded("pages", d.find_all("html", r"(?is)(<a\s[^>]*>.*?)</a>"), "nth", "a", "page_id, url")
    return f"(SELECT page_id, url, nth, {d.find('a', r'(?i)href=[\x22\x27]?([^\x22\x27\s>]*)')} AS href, {strip(d, d.sub('a', r'(?s)<[^>]*>', ''))} AS label FROM {anchors} x)"


def absolute(d: Spark) -> str:
    base = d.find("url", r"^([^:]+://[^/?#]*)")
    bare, tail = d.find("href", r"^([^?#]*)"), d.find("href", r"^[^?#]*(.*)")
    rooted = f"CASE WHEN substring(href, 1, 1) = '/' THEN {bare} ELSE concat('/', {bare}) END"
    path = f"concat({d.without_dots(rooted)}, CASE WHEN {d.matches(bare, r'(^|/)[.][.]?$')} THEN '/' ELSE '' END)"
    return f"CASE WHEN {d.matches('href', r'^[A-Za-z][A-Za-z0-9+.-]*:')} THEN href WHEN substring(href, 1, 2) = '//' THEN concat({d.find('url', r'^([^:]+:)')}, href) WHEN href = '' THEN {base} WHEN substring(href, 1, 1) IN ('#', '?') THEN concat({base}, href) ELSE concat({base}, {path}, {tail}) END"


def resolve_links(d: Spark) -> str:
    return f"SELECT page_id, nth, {absolute(d)} AS target FROM {links(d)} l"


def same_domain_links(d: Spark) -> str:
    bare = lambda x: d.sub(host(d, x), r"^www\.", "")
    return f"SELECT page_id, count(*) AS n_links, sum(CASE WHEN {bare('target')} = {bare('url')} THEN 1 ELSE 0 END) AS n_same FROM (SELECT page_id, url, {absolute(d)} AS target FROM {links(d)} l) r GROUP BY page_id"


def link_placeholders(d: Spark) -> str:
    """Where each link would lead as a placeholder; absolute links only are rewritten, shown here for all."""
    slug = d.sub(d.sub("substring(lower(label), 1, 30)", "[^a-z0-9]+", "-"), "^-+|-+$", "")
    social = any_of("lower(target)", v.SOCIAL_HOSTS)
    by_text = " ".join(f"WHEN {any_of('lower(label)', words)} THEN '{to}'" for words, to in v.LINK_WORDS)
    segment = d.last_part(d.sub("href", "/+$", ""), "/")
    return f"""SELECT page_id, nth, CASE WHEN {social} THEN '#' {by_text} WHEN {slug} <> '' THEN concat('/', {slug}) WHEN label = '' AND {segment} <> '' THEN concat('/', {segment}) ELSE '#' END AS placeholder
        FROM (SELECT page_id, nth, href, label, {absolute(d)} AS target FROM {links(d)} l) r"""


def cdn_filter(d: Spark) -> str:
    return f"SELECT page_id, nth, href FROM {links(d)} l WHERE NOT {any_of('lower(href)', v.CDN_WORDS)} AND href <> '' AND substring(href, 1, 1) <> '#' AND substring(href, 1, 5) <> 'data:'"


def style_cdn_filter(d: Spark) -> str:
    """Stylesheets that aren't of a library's host."""
    sheets = d.exploded("pages", d.find_all("html", r"(?is)<link\s[^>]*>", 0), "nth", "tag", "page_id")
    href = d.find("tag", r"(?i)href=[\x22\x27]?([^\x22\x27\s>]*)")
    return f"SELECT page_id, nth, href FROM (SELECT page_id, nth, tag, {href} AS href FROM {sheets} s) t WHERE {d.matches('tag', r'(?i)rel=[\x22\x27]?stylesheet')} AND href <> '' AND NOT {any_of('lower(href)', v.STYLE_CDN_WORDS)}"


def folder_names(d: Spark) -> str:
    """A host's folder name and the url that it stands for. Both come from the page's url: a name alone can't tell http before an s from https."""
    parts = f"SELECT page_id, split_part(url, '://', 1) AS scheme, {d.find("split_part(url, '://', 2)", '^[^/?#]*', 0)} AS host FROM pages"
    return f"SELECT page_id, scheme || host AS folder, scheme || '://' || host AS target FROM ({parts}) t"


def page_industry(d: Spark) -> str:
    return f"WITH f AS {facts(d)} SELECT page_id, {industry('title')} AS industry FROM f"


def photo_usage(d: Spark) -> str:
    return f"WITH {characteristics(d)} SELECT photo_usage, count(*) AS n, CAST(sum(images) AS BIGINT) AS images FROM ch GROUP BY photo_usage"


def color_topk(d: Spark) -> str:
    return f"WITH {scheme(d)} SELECT top.page_id, token, n, CAST(place AS BIGINT) AS place, color_scheme FROM top JOIN schemes ON top.page_id = schemes.page_id"


def processed_sites_antijoin(d: Spark) -> str:
    return f"SELECT page_id, url FROM pages p WHERE NOT EXISTS (SELECT 1 FROM pages q WHERE q.page_id < p.page_id AND {host(d, 'q.url')} = {host(d, 'p.url')})"


def resume_offset(d: Spark) -> str:
    return "SELECT page_id FROM (SELECT page_id, row_number() OVER (ORDER BY page_id) AS nth, count(*) OVER () AS n FROM pages) t WHERE nth >= CASE WHEN 101 > n THEN 1 ELSE 101 END"


def example_numbering(d: Spark) -> str:
    return f"SELECT page_id, {d.numbered('row_number() OVER (ORDER BY page_id)')} AS folder FROM pages"


def filename_conflicts(d: Spark) -> str:
    name = d.last_part(d.find("url", r"^[^:]+://[^/?#]*([^?#]*)"), "/")
    return f"""WITH n AS (SELECT page_id, {host(d, 'url')} AS site, {name} AS name FROM pages), r AS (SELECT *, row_number() OVER (PARTITION BY site, name ORDER BY page_id) - 1 AS k FROM n)
        SELECT page_id, CASE WHEN k = 0 THEN name ELSE concat(name, '_', k) END AS unique_name FROM r"""


def example_type_counts(d: Spark) -> str:
    kind = "CASE WHEN contains(lower(instruction), 'full page') OR contains(lower(instruction), 'complete') THEN 'full' WHEN contains(instruction, '+') OR contains(lower(instruction), 'group') THEN 'grouped' ELSE 'component' END"
    return f"SELECT kind, count(*) AS n, CAST(sum(length(output)) AS BIGINT) AS chars FROM (SELECT {kind} AS kind, output FROM ({full_page_examples(d)}) e) k GROUP BY kind"


def code_block_roundtrip(d: Spark) -> str:
    reasoning = strip(d, d.sub(d.first_part("output", "Code:"), "^Design reasoning:", ""))
    html, css = d.find("output", r"(?s)```html\s*\n(.*?)```"), d.find("output", r"(?s)```css\s*\n(.*?)```")
    return f"SELECT page_id, {reasoning} AS reasoning, {strip(d, html)} AS html, {strip(d, css)} AS css FROM ({full_page_examples(d)}) e"


QUERIES = (
    full_page_examples, page_characteristics, design_keywords, page_titles, script_urls, inline_css, inline_js, minified_flag, visible_text, strip_comment_artifacts, doctype_charset, sanitize_url, base_domain,
    asset_filename, resolve_links, same_domain_links, link_placeholders, cdn_filter, style_cdn_filter, folder_names, page_industry, photo_usage, color_topk, processed_sites_antijoin, resume_offset, example_numbering,
    filename_conflicts, example_type_counts, code_block_roundtrip,
)
