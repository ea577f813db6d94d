"""Trees of elements from classified chunks.

The stack automaton runs once per document over chunks in order and keeps only
the open elements; it gives nodes as rows. Where rules only open levels, the
same tree comes from windows alone (level_tree).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NODE = "node_id long, parent_id long, ord long, depth int, kind string, tag string, attrs map<string,string>, text string"


class Stack:
    """Open elements of one document. Nodes are given when they open, texts
    when they are appended; nothing closed is kept. A hook, by tag and type,
    is called with an element's text when it closes; an element of the same
    tag and a number of its own gets an id where ids are asked for."""

    def __init__(self, root: str = "body", hooks: dict[tuple[str, str | None], Callable] | None = None, ids: str | None = None):
        self.rows: list[tuple] = []
        self.counts: dict[str, int] = {}
        self.next, self.ord = 0, 0
        self.open: list[tuple[int, str, dict, bool]] = []
        self.filled: set[int] = set()
        self.bodies: set[int] = set()
        self.hooks, self.ids, self.heard, self.state = hooks or {}, ids, {}, {}
        self.push(root)

    def push(self, tag: str, cosmetic: bool = False, **attrs: str) -> None:
        self.counts[tag] = self.counts.get(tag, 0) + 1
        if self.ids and "xml:id" not in attrs and self.open:
            attrs = {"xml:id": f"{self.ids}.{tag}{self.counts[tag]}"} | attrs
        attrs = {k: printable(v) for k, v in attrs.items() if v is not None}
        parent = self.open[-1][0] if self.open else None
        if parent is not None:
            self.filled.add(parent)
            if tag != "head":
                self.bodies.add(parent)
        self.rows.append((self.next, parent, self.ord, len(self.open), "element", tag, attrs, None))
        self.open.append((self.next, tag, attrs, cosmetic))
        if (tag, attrs.get("type")) in self.hooks:
            self.heard[self.next] = []
        self.next += 1
        self.ord += 1

    def pop(self) -> None:
        if len(self.open) > 1:
            node, tag, attrs, _ = self.open.pop()
            self.filled.discard(node)
            self.bodies.discard(node)
            if node in self.heard:
                self.hooks[tag, attrs.get("type")](self, " ".join(self.heard.pop(node)))

    def top(self) -> str:
        """The tag of the innermost element that isn't cosmetic."""
        return next((t for _, t, _, cosmetic in reversed(self.open) if not cosmetic), "")

    def attribute(self, name: str) -> str | None:
        return next((a.get(name) for _, _, a, cosmetic in reversed(self.open) if not cosmetic), None)

    def within(self, tag: str, **attrs: str) -> bool:
        return any(t == tag and all(a.get(k) == v for k, v in attrs.items()) for _, t, a, _ in self.open)

    def nearest(self, tag: str, name: str) -> str | None:
        """An attribute of the innermost open element of a tag ('' if it lacks
        it); None without such an element."""
        return next((a.get(name, "") for _, t, a, _ in reversed(self.open) if t == tag), None)

    def has_body(self) -> bool:
        """Whether the innermost element has children other than headings."""
        return self.open[-1][0] in self.bodies

    def pop_to(self, *tags: str, invert: bool = False) -> None:
        """Close until one of the tags is on top (invert: while); the root stays."""
        while len(self.open) > 1 and (self.open[-1][1] in tags) == invert:
            self.pop()

    def on_top(self, tag: str, **attrs: str) -> bool:
        """Whether the innermost element that isn't cosmetic is that one."""
        for _, t, a, cosmetic in reversed(self.open):
            if not cosmetic:
                return t == tag and all(a.get(k) == v for k, v in attrs.items())
        return False

    def pop_push(self, *to: str, tag: str, again: bool = True, **attrs: str) -> None:
        """Close to one of `to` and open the tag, unless it's on top already."""
        if again and self.on_top(tag, **attrs):
            return
        self.pop_to(*to)
        self.push(tag, **attrs)

    def text(self, text: str | None, space: bool = True, kind: str = "text") -> None:
        text = (text or "").strip()
        if text:
            at = self.open[-1][0]
            lead = " " if kind == "text" and space and at in self.filled else ""
            text = printable(text)
            self.rows.append((self.next, at, self.ord, len(self.open), kind, None, {}, lead + text))
            if at in self.heard and kind == "text":
                self.heard[at].append(text)
            self.filled.add(at)
            self.next += 1
            self.ord += 1

    def comment(self, text: str | None) -> None:
        text = (text or "").replace("--", "- -")
        self.text(text + " " if text.endswith("-") else text, kind="comment")


_UNFIT = re.compile("[^\t\n\r\x20-\ud7ff\ue000-\ufffd\U00010000-\U0010ffff]")


def printable(text: str) -> str:
    """Characters that XML forbids as visible tokens."""
    return _UNFIT.sub(lambda m: f"[U+{ord(m[0]):04X}]", str(text))


OPERATIONS = ("push", "pop", "pop_to", "pop_push", "append", "comment")


def run(stack: Stack, actions: tuple[tuple, ...], row: dict) -> None:
    """Apply a rule's actions. Attribute values in braces name chunk columns."""
    for op, *args in actions:
        named = args.pop() if args and isinstance(args[-1], dict) else {}
        attrs = {k: v.format(**row) if isinstance(v, str) else v for k, v in named.items()}
        if op == "append":
            stack.text(row["text"], bool(row.get("space_before", True)))
        elif op == "comment":
            stack.comment(row["text"])
        elif op == "pop":
            stack.pop()
        elif op in ("push", "pop_to", "pop_push"):
            getattr(stack, op)(*args, **attrs)
        else:
            raise ValueError(f"no such operation: {op}")


def build_trees(chunks: DataFrame, doc: str, order: list[str], rule: str, actions: dict[str, tuple[tuple, ...]], root: str = "body") -> DataFrame:
    """Nodes of every document: doc and NODE's columns.

    Chunks need text and may have space_before. A chunk without rule, or of
    one without actions, is appended to what is open; one whose actions fail
    is kept as unparsed text. Chunks of a document arrive sorted and stream
    through, so that only open elements and one batch are held.
    """
    kind = dict(chunks.dtypes)[doc]

    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, stack = None, None
        for b in batches:
            out = []
            for row in b.to_dict("records"):
                if stack is None or row[doc] != at:
                    at, stack = row[doc], Stack(root)
                todo = actions.get(row[rule]) or (("append",),)
                depth = len(stack.rows)
                try:
                    run(stack, todo, row)
                except (ValueError, KeyError, TypeError) as e:
                    del stack.rows[depth:]
                    stack.comment(str(e)[:500])
                    stack.push("seg", type="unparsed")
                    stack.text(row["text"])
                    stack.pop()
                out += [(at, *r) for r in stack.rows]
                stack.rows.clear()
            yield pd.DataFrame(out, columns=[doc, "node_id", "parent_id", "ord", "depth", "kind", "tag", "attrs", "text"])

    sorted_chunks = chunks.repartition(F.col(doc)).sortWithinPartitions(doc, *order)
    return sorted_chunks.mapInPandas(grow, f"{doc} {kind}, {NODE}")


def level_tree(nodes: DataFrame, doc: str, seq: str, level: str) -> DataFrame:
    """Add parent_seq: the last row before with a lower level. Pure windows,
    for rules that only close to a level and open it."""
    w = Window.partitionBy(doc).orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    levels = F.struct(*[F.max(F.when(F.col(level) == n, F.col(seq))).over(w).alias(f"l{n}") for n in range(6)])
    df = nodes.withColumn("__l", levels)
    candidates = F.array(*[F.when(F.col(level) > n, F.col(f"__l.l{n}")) for n in range(6)])
    return df.withColumn("parent_seq", F.array_max(F.array_compact(candidates))).drop("__l")


def serialized(nodes: DataFrame, doc: str, indent: bool = False) -> DataFrame:
    """doc, xml: the tree of each document as text. Nodes stream in order; of
    a document only its own text is held."""
    kind = dict(nodes.dtypes)[doc]

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, parts, open_ = None, [], []

        def finish() -> pd.DataFrame:
            parts.extend(f"</{t}>" for _, t in reversed(open_))
            return pd.DataFrame({doc: [at], "xml": ["".join(parts)]})

        for b in batches:
            for d, depth, k, tag, attrs, text in zip(b[doc], b["depth"], b["kind"], b["tag"], b["attrs"], b["text"]):
                if d != at:
                    if at is not None:
                        yield finish()
                    at, parts, open_ = d, [], []
                while open_ and open_[-1][0] >= depth:
                    parts.append(f"</{open_.pop()[1]}>")
                if k == "element":
                    pairs = attrs.items() if isinstance(attrs, dict) else attrs or ()
                    parts.append(("\n" + " " * depth if indent and depth else "") + f"<{tag}" + "".join(f" {a}={quoteattr(v)}" for a, v in sorted(pairs)) + ">")
                    open_.append((depth, tag))
                elif k == "comment":
                    parts.append(f"<!--{text}-->")
                else:
                    parts.append(escape(text))
        if at is not None:
            yield finish()

    columns = [doc, "depth", "kind", "tag", "attrs", "text"]
    rows = nodes.repartition(F.col(doc)).sortWithinPartitions(doc, "ord").select(*columns)
    return rows.mapInPandas(write, f"{doc} {kind}, xml string")


def tag_usage(nodes: DataFrame, doc: str) -> DataFrame:
    return nodes.where("kind = 'element'").groupBy(doc, "tag").agg(F.count("*").alias("n"))


def extents(nodes: DataFrame, doc: str) -> DataFrame:
    """doc, speeches, words: utterances, and words of all text nodes."""
    return nodes.groupBy(doc).agg(
        F.count_if(F.col("tag") == "u").alias("speeches"),
        F.sum(F.when(F.col("kind") == "text", F.regexp_count("text", F.lit(r"(?U)\S+"))).otherwise(0)).alias("words"),
    )


def sequential_ids(df: DataFrame, by: list[str], order: list[str], tag: Column, prefix: Column) -> DataFrame:
    """Add `id`: prefix.tag and the number of the element of its kind."""
    df = df.withColumn("__tag", tag)
    w = Window.partitionBy(*by, "__tag").orderBy(*order)
    return df.withColumn("id", F.concat(prefix, F.lit("."), F.col("__tag"), F.row_number().over(w))).drop("__tag")


def unique_ids(df: DataFrame, by: list[str], order: list[str], base: Column, name: str = "id") -> DataFrame:
    """Add ids of which none occurs twice: in order, the base if it is free,
    else base-2, base-3 ... up to the first that is free.

    Only bases that may collide - those that repeat, or that end in a number
    and, without such ends, equal another base - go through a fold, family by
    family; all other rows keep their base without it. A hot base (a third of
    all rows) is numbered by windows, unless another base could be one of its
    numbers.
    """
    keys, out = [F.col(c) for c in by], df.columns
    df = df.withColumn("__base", base).withColumn("__stem", F.regexp_replace(F.col("__base"), r"(?:-\d+)+$", ""))
    family = df.groupBy(*by, "__stem").agg((F.count_distinct("__base") > 1).alias("__mixed"))
    family = family.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate([*by, "__stem"])], "__mixed")
    on = [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate([*by, "__stem"])]
    df = df.join(family, on, "left").select(*df.columns, F.coalesce("__mixed", F.lit(False)).alias("__mixed"))
    n = F.row_number().over(Window.partitionBy(*by, "__base").orderBy(*order))
    made = F.when(n == 1, F.col("__base")).otherwise(F.concat_ws("-", "__base", n.cast("string")))
    plain = df.where(~F.col("__mixed")).withColumn(name, made)
    at = F.row_number().over(Window.partitionBy(*by, "__stem").orderBy(*order))
    mixed = df.where("__mixed").withColumn("__at", at)
    schema = mixed.select(*out).schema.add(name, "string")

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, used, after = None, set(), {}
        for b in batches:
            ids = []
            for key, x in zip(zip(*[b[c] for c in by], b["__stem"]), b["__base"]):
                if key != last:
                    last, used, after = key, set(), {}
                made, k = x, after.get(x, 1)
                while made in used:
                    k += 1
                    made = f"{x}-{k}"
                after[x] = k
                used.add(made)
                ids.append(made)
            yield b[out].assign(**{name: ids})

    streamed = mixed.repartition(*keys, F.col("__stem")).sortWithinPartitions(*by, "__stem", "__at")
    return plain.select(*out, name).unionByName(streamed.mapInPandas(number, schema))


def footnote_ids(df: DataFrame, doc: str, number: str, page: str, order: list[str]) -> DataFrame:
    """Add `id` of footnote definitions: note and the number; on a later page
    with the page; repeated there with a count too."""
    rd = F.row_number().over(Window.partitionBy(doc, number).orderBy(*order))
    rp = F.row_number().over(Window.partitionBy(doc, number, page).orderBy(*order))
    first = F.first(page).over(Window.partitionBy(doc, number).orderBy(*order))
    k = rp - (F.col(page) == first).cast("int")
    base = F.concat(F.lit("note"), F.col(number).cast("string"))
    paged = F.concat(base, F.lit("-p"), (F.col(page) + 1).cast("string"))
    return df.withColumn("id", F.when(rd == 1, base).when(k <= 1, paged).otherwise(F.concat_ws("-", paged, k.cast("string"))))


def linked_footnotes(refs: DataFrame, definitions: DataFrame, on: list[str]) -> DataFrame:
    """Add target and rend to references: linked to the first definition of
    their number on their page, or else a mere superscript."""
    first = definitions.groupBy(*on).agg(F.min("id").alias("__id"))
    return refs.join(first, on, "left").withColumn("target", F.concat(F.lit("#"), F.col("__id"))).withColumn(
        "rend", F.when(F.col("__id").isNull(), "superscript")
    ).drop("__id")


def rewritten_references(df: DataFrame, key: list[str], refs: str, ids: DataFrame) -> DataFrame:
    """key..., refs with every token replaced through ids (raw, id), in order;
    tokens without one stay."""
    tokens = df.select(*key, F.posexplode(F.split(F.trim(refs), r"\s+")).alias("pos", "token"))
    tokens = tokens.withColumn("raw", F.regexp_replace("token", "^#", ""))
    mapped = tokens.join(ids, "raw", "left").withColumn("token", F.when(F.col("id").isNotNull(), F.concat(F.lit("#"), F.col("id"))).otherwise(F.col("token")))
    listed = F.array_sort(F.collect_list(F.struct("pos", "token")))
    return mapped.groupBy(*key).agg(F.array_join(F.transform(listed, lambda t: t["token"]), " ").alias(refs))
