"""Main text of pages by wrapper induction over pages of one host."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, dom

#: Pages that are aligned with one exemplar, at most about; hosts with more pages are dealt into such groups by hash.
GROUP = 64

#: A text is template if it stands at its place in this share of the host's aligned pages, and in so many.
SHARE, LEAST = 0.6, 5

#: Rows of all templates up to which they go to all executors (about 100 bytes each), and hosts with their numbers.
BROADCAST_ROWS = 50_000

#: Kinds of a template's rows: a constant text, a slot, and the number of aligned pages.
TEXT, SLOT, PAGES = 0, 1, 2


def host_of(url: Column) -> Column:
    """Lower-case host of an absolute URL, else empty."""
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))


def _signed(x: int) -> int:
    return x - (1 << 63)


def _text(node: dom.Node) -> int:
    """Hash of a text at its place."""
    return _signed(dom.step(node.path, f"{xxhash.xxh64_intdigest(dom.tidy(node.text))}"))


def _skeleton(root: dom.Node) -> list:
    """The tree as rows [depth, label] and, for texts, [depth, hash, words], without banned elements.

    What lies deeper than dom.DEPTH is put on that level, so trees of any depth can be aligned.
    """
    out, todo = [], [(root, 0)]
    while todo:
        node, depth = todo.pop()
        if node.tag == "#":
            if t := dom.tidy(node.text):
                out.append([depth, xxhash.xxh64_intdigest(t), t.count(" ") + 1])
        elif not node.banned:
            out.append([depth, node.label])
            todo += [(c, min(depth + 1, dom.DEPTH)) for c in reversed(node.children)]
    return out


def _tree(rows: list) -> dom.Node:
    """The tree of a skeleton. A text node's text is its hash, and plain its words."""
    root = dom.Node("root")
    last = [root]
    for depth, x, *words in rows[1:]:
        node = dom.Node("#", "#", str(x), plain=words[0]) if words else dom.Node(x.split(".")[0], x)
        del last[depth:]
        last[-1].children.append(node)
        if not words:
            last.append(node)
    return dom.measured(root)


def _votes(trees: list[dom.Node]) -> dict[tuple[int, int], list[int]]:
    """Rows of a template (kind, slot): [n, plain, linked], from the trees of one group.

    Each tree is aligned with one of middle size, the first in the order given among equals. A text that equals the one
    it is aligned with is constant; words of all others are varying and count for the slots of the elements around them.
    """
    out: dict[tuple[int, int], list[int]] = {(PAGES, 0): [0, 0, 0]}

    def add(key, values):
        known = out.setdefault(key, [0, 0, 0])
        for i, v in enumerate(values):
            known[i] += v

    if len(trees) > 1:
        exemplar, weights = sorted(trees, key=lambda t: t.size)[len(trees) // 2], {}
        for t in trees:
            if t is exemplar:
                continue
            same = {id(y) for x, y in dom.aligned(exemplar, t, weights) if x.text == y.text}
            held, found, words = set(), [t], {}
            while found:
                node = found.pop()
                found += node.children
                if node.tag == "#":
                    words[id(node)] = 0 if id(node) in same else node.plain
                    if id(node) in same:
                        held.add(_signed(dom.step(node.path, node.text)))
            for slot in held:
                add((TEXT, slot), (1, 0, 0))
            for path, values in dom.weighed(t, lambda x: words[id(x)]).items():
                add((SLOT, _signed(path)), values)
            add((PAGES, 0), (1, 0, 0))
    return out


def templates(pages: DataFrame) -> DataFrame:
    """host, kind, slot, n, plain, linked: the wrapper of each host, induced from its pages.

    kind TEXT: slot is the hash of a text and its place that stands in n pages, SHARE of the aligned ones or more, and
    LEAST or more. kind SLOT: slot is the hash of an element's place (labels from the root); n: how many such elements
    there are; plain, linked: varying words below them, outside and inside links. Fewer than LEAST aligned pages give no
    template, as copies could pass for one. Trees without texts (labels, hashes,
    numbers of words) are dealt by their hash into groups of about GROUP trees of one host, and aligned there by simple
    tree matching; figures of all groups are added. Equal trees count once, and are combined before they move. The
    unknown host has no template.
    """

    def skeletons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for b in batches:
            blobs = [packer.compress(json.dumps(_skeleton(dom.parse(x)), separators=(",", ":")).encode()) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(blobs, pa.binary()), pa.array([_signed(xxhash.xxh64_intdigest(x)) for x in blobs], pa.int64())], ["host", "tree", "tree_hash"])

    def votes(table: pa.Table) -> pa.Table:
        reader = zstandard.ZstdDecompressor()
        packed = sorted(zip(table.column("tree_hash").to_pylist(), table.column("tree").to_pylist()))
        found = _votes([_tree(json.loads(reader.decompress(x))) for _, x in packed])
        cols = [[k for k, _ in found], [s for _, s in found], *([v[i] for v in found.values()] for i in range(3))]
        host = table.column("host")[0].as_py()
        return pa.table({"host": [host] * len(found), "kind": pa.array(cols[0], pa.int32()), "slot": pa.array(cols[1], pa.int64()), "n": pa.array(cols[2], pa.int64()), "plain": pa.array(cols[3], pa.int64()), "linked": pa.array(cols[4], pa.int64())})

    known = pages.select(host_of(F.col("url")).alias("host"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")).filter("host != ''")
    trees = common.map_arrow(known, skeletons, "host string, tree binary, tree_hash long")
    trees = common.written(trees.dropDuplicates(["host", "tree_hash"]))
    counts = common.written(trees.groupBy("host").agg(F.ceil(F.count("*") / GROUP).alias("groups")))
    counts = F.broadcast(counts) if counts.count() <= BROADCAST_ROWS else counts
    dealt = trees.join(counts, "host").withColumn("deal", F.pmod(F.xxhash64("tree_hash"), "groups")).repartition("host", "deal")
    found = common.group_arrow(dealt.groupBy("host", "deal"), votes, "host string, kind int, slot long, n long, plain long, linked long")
    found = common.written(found.groupBy("host", "kind", "slot").agg(*(F.sum(c).alias(c) for c in ("n", "plain", "linked"))))
    total = found.filter(F.col("kind") == PAGES).select("host", F.col("n").alias("pages"))
    often = (F.col("n") >= LEAST) & (F.col("n") >= SHARE * F.col("pages"))
    enough = F.col("pages") >= LEAST
    return found.filter(F.col("kind") != PAGES).join(total, "host").filter(enough & ((F.col("kind") == SLOT) | often)).drop("pages")


def extract(pages: DataFrame, *, marks: bool = True) -> DataFrame:
    """page_id, url, text, n_chars for every row of pages (page_id, url, html; others are ignored).

    The text is the article's: its blocks in page order, joined by blank lines. The host's template (see templates) says
    which texts are constant and what each slot holds; dom.article follows the varying text to the article and leaves
    out what lies beside it. A page whose host has no template is read by itself. Null and empty html give an empty
    text; broken markup and very long or deep pages are read to the end; pages of an unknown host (null or relative url)
    have no template. Repeated rows are each returned; an empty table gives an empty one. marks: see dom.article.
    """
    found = templates(pages).groupBy("host").agg(F.sort_array(F.collect_list(F.struct("kind", "slot", "n", "plain", "linked"))).alias("template"))
    found = common.written(found)
    size = found.agg(F.coalesce(F.sum(F.size("template")), F.lit(0))).first()[0]
    kind = {f.name: f.dataType.simpleString() for f in pages.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, texts_, slots = None, frozenset(), None
        for b in batches:
            texts = []
            for source, host, own in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4)):
                if not own.is_valid:
                    last, texts_, slots = None, frozenset(), None
                elif host != last:
                    rows = own.as_py()
                    last, texts_ = host, frozenset(r["slot"] for r in rows if r["kind"] == TEXT)
                    slots = {r["slot"] + (1 << 63): [r["n"], r["plain"], r["linked"]] for r in rows if r["kind"] == SLOT}
                root = dom.measured(dom.parse(source))
                texts.append(dom.article(root, (lambda x: _text(x) in texts_) if texts_ else lambda x: False, slots, marks))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), host_of(F.col("url")).alias("host"))
    rows = rows.join(F.broadcast(found) if size <= BROADCAST_ROWS else found, "host", "left").select("page_id", "url", "html", "host", "template")
    return common.map_arrow(rows, run, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
