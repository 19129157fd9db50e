"""Layout-aware text of HTML pages: a tree with implied tags, and the text that a reader would see.

Blocks stand on lines of their own, paragraphs and headings between blank lines, list items behind their mark and
indented by depth, table rows on one line each with their cells in aligned columns.
"""

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Element names by the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = set("head script style template noscript title iframe noembed noframes object audio video canvas datalist".split())
#: What leaves an open head open, and what svg and math hold besides what they show.
HEAD_CONTENT = set("head title meta link base basefont bgsound script style template noscript noframes".split())
UNSHOWN = {"svg": set("desc defs metadata symbol clippath mask marker pattern".split()), "math": {"annotation", "annotation-xml"}}
PARAGRAPHS = set("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure fieldset hr".split())
BLOCKS = PARAGRAPHS | set("address article aside body details dd div dt footer form header hgroup html legend li main nav section summary tr caption center figcaption option tbody thead tfoot".split())
#: What a start tag ends before it opens, and what such an end may not go beyond.
CLOSES = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
          "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "tr": ({"tr", "td", "th", "caption"}, {"table"}),
          **dict.fromkeys(["tbody", "thead", "tfoot"], ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"})), "body": ({"head"}, set())}
SCOPE = {"table", "td", "th", "caption", "html", "template", "button", "object"}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
SPACE = re.compile(r"[ \t\r\n\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


def tree(page: str) -> Node:
    """The page's elements; missing tags are implied, stray ones ignored, open ones ended with the page."""
    root = Node("#root", {})
    stack, at, last = [root], 0, page.rfind(">") + 1
    opened: Counter = Counter()

    def end_head() -> None:
        if stack[-1].tag == "head":
            opened[stack.pop().tag] -= 1

    def text(part: str) -> None:
        if part.strip(" \t\r\n\f"):
            end_head()
        if part:
            stack[-1].children.append(part)

    def end(names: set[str], stops: set[str]) -> None:
        if not any(opened[n] for n in names):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in names:
                deepest = k
                while deepest > 1 and stack[deepest - 1].tag in names:
                    deepest -= 1
                opened.subtract(n.tag for n in stack[deepest:])
                del stack[deepest:]
                return
            if stack[k].tag in stops:
                return

    def start(tag: str, attrs: dict[str, str]) -> None:
        stack[-1].children.append(node := Node(tag, attrs))
        if tag not in VOID:
            stack.append(node)
            opened[tag] += 1

    while found := TOKEN.search(page, at, last):
        text(html.unescape(page[at:found.start()]))
        at = found.end()
        closing, tag, inner = found.groups()
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            if tag == "p" and not opened["p"]:
                start("p", {})
            end({tag}, SCOPE - {tag} if tag != "table" else {"html"})
            continue
        if tag not in HEAD_CONTENT:
            end_head()
        if tag in BLOCKS:
            end({"p"}, SCOPE)
        if tag in CLOSES:
            end(*CLOSES[tag])
        if tag == "tr" and stack[-1].tag == "table":
            start("tbody", {})
        if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
            start("tr", {})
        attrs = {k.lower(): html.unescape(v.strip("\"'")) for k, v in ATTRIBUTE.findall(inner)}
        foreign = [kind for kind in UNSHOWN if opened[kind] > 0]
        if any(tag in UNSHOWN[kind] for kind in foreign):
            attrs["hidden"] = ""
        start(tag, attrs)
        if inner.endswith("/") and (foreign or tag in UNSHOWN) and stack[-1].tag == tag:
            opened[stack.pop().tag] -= 1
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            text(page[at:close.start() if close else len(page)] if tag not in ("textarea", "title") else html.unescape(page[at:close.start() if close else len(page)]))
            at = close.end() if close else len(page)
            opened[stack.pop().tag] -= 1
    text(html.unescape(page[at:]))
    return root


def hidden(node: Node) -> bool:
    a = node.attrs
    return (node.tag in HIDDEN or "hidden" in a or bool(UNSEEN.search(a.get("style", ""))) or node.tag == "input"
            or node.tag == "dialog" and "open" not in a)


class Lines:
    """Lines of text; white space is folded, and blank lines between paragraphs are asked for, not added up."""

    def __init__(self):
        self.lines, self.line, self.blank, self.indent, self.mark = [], "", False, 0, ""

    def add(self, text: str) -> None:
        text = SPACE.sub(" ", text)
        if not self.line or self.line.endswith(" "):
            text = text.lstrip(" ")
        if text and not self.line:
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = False
            self.line = " " * max(0, self.indent - len(self.mark)) + self.mark
            self.mark = ""
        self.line += text

    def add_as_is(self, text: str) -> None:
        if not self.line and self.blank and self.lines:
            self.lines.append("")
        self.blank = False
        first, *rest = text.split("\n")
        self.line += first
        for line in rest:
            self.lines.append(self.line.rstrip())
            self.line = line

    def stop(self, blank: bool = False) -> None:
        if self.line.strip():
            self.lines.append(self.line.rstrip())
        self.line = ""
        self.blank |= blank

    def text(self) -> str:
        self.stop()
        return "\n".join(self.lines)


def aligned(rows: list[list[str]]) -> list[str]:
    widths = [max((len(r[k]) for r in rows if k < len(r)), default=0) for k in range(max(map(len, rows), default=0))]
    return [" | ".join(c.ljust(w) for c, w in zip(r, widths)).rstrip() for r in rows]


def visible_text(page: str) -> str:
    """What a reader sees of a page.  Works through the tree with a list of steps, so depth has no limit."""
    outs, tables, lists, pre = [Lines()], [], [], 0
    steps: list = [tree(page)]
    while steps:
        step = steps.pop()
        out = outs[-1]
        if isinstance(step, str):
            if pre:
                out.add_as_is(step)
            else:
                out.add(step)
            continue
        if isinstance(step, tuple):  # the end of an element
            tag = step[0].tag
            if tag in ("td", "th"):
                cell = " ".join(outs.pop().text().split())
                if not tables or not tables[-1]:
                    outs[-1].add(cell)
                else:
                    span = step[0].attrs.get("colspan", "1")
                    tables[-1][-1].extend([cell, *[""] * (min(int(span), 100) - 1 if span.isdecimal() and int(span) else 0)])
            elif tag == "table":
                for line in aligned([r for r in tables.pop() if any(r)]):
                    out.stop()
                    out.add("|")
                    out.line = out.line[:-1] + line
            elif tag in ("ul", "ol"):
                lists.pop()
                out.indent -= 3
            elif tag == "pre":
                pre -= 1
            elif tag == "dd":
                out.indent -= 3
            if tag in BLOCKS or tag == "text":  # a text of an svg stands alone
                out.stop(tag in PARAGRAPHS and not (tag in ("ul", "ol") and lists))
            continue
        if hidden(step):
            continue
        tag = step.tag
        if tag == "br":
            out.stop() if out.line.strip() else None
            continue
        if tag == "img":
            out.add(step.attrs.get("alt", ""))
            continue
        if tag in BLOCKS or tag == "text":
            out.stop(tag in PARAGRAPHS and not (tag in ("ul", "ol") and lists))
        if tag in ("ul", "ol"):
            lists.append([0] if tag == "ol" else None)
            out.indent += 3
        elif tag == "li":
            if lists and lists[-1]:
                lists[-1][0] += 1
            out.mark = f"{lists[-1][0]}. " if lists and lists[-1] else "- "
        elif tag == "dd":
            out.indent += 3
        elif tag == "pre":
            pre += 1
        elif tag == "table":
            tables.append([])
        elif tag == "tr" and tables:
            tables[-1].append([])
        elif tag in ("td", "th"):
            outs.append(Lines())
        steps.append((step,))
        steps.extend(reversed(step.children))
    return outs[0].text()


def page_texts(pages: DataFrame) -> DataFrame:
    """``page_id`` and ``text``, the visible text, of each row of ``pages`` (page_id, html); other columns are ignored.

    Null and empty pages have an empty text.  Broken markup is read as far as it goes.  Repeated rows get a row each.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                texts = [visible_text(page) for page in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), pa.array(texts, pa.string())], ["page_id", "text"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("html", F.lit("")).alias("html")).mapInArrow(run, "page_id long, text string")
