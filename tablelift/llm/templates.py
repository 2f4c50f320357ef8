"""HTML extraction by equivalence classes: tokens that occur equally often on every page of a host make up its template.

A token is a tag or a word under its path. Tokens with one occurrence vector form a class; classes that keep one order on all pages and
lie inside each other are the template, and what stands between its tags are slots. The main text is what its slots hold, without
blocks that are nothing but template.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelift.llm import common, html_pages
from tablelift.llm.common import mix64


@dataclass(frozen=True)
class Template:
    pages: int = 4  # least pages of a host with a template
    share: float = 0.5  # least share of the pages that hold a token of a class
    least: int = 2  # least tokens of a class
    salts: int = 64  # tasks at least over which a host is spread where templates are not sent to all tasks
    sent_bytes: int = 32_000_000  # templates up to this size are sent to all tasks


def host(url: str = "url") -> Column:
    """Lower-case host of a URL without user, port and last dot; null where there is none."""
    name = F.regexp_extract(F.lower(F.col(url)), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+?)\.?(?:[:/?#]|$)", 1)
    return F.when(name != "", name)


def with_hosts(left: DataFrame, hosts: DataFrame, size: Column, how: Template, kind: str = "inner") -> DataFrame:
    """``left`` (host, ...) with the columns of ``hosts``, one row per host, of ``size`` bytes each.

    They are sent to all tasks if they are small, which is measured. If not, both sides are dealt by host and salt, so that no host
    lies in one task.
    """
    if (hosts.agg(F.sum(size)).first()[0] or 0) <= how.sent_bytes:
        return left.join(F.broadcast(hosts), "host", kind)
    salted = hosts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(how.salts - 1))))
    drawn = left.withColumn("salt", F.floor(F.rand(7) * how.salts).cast("int"))
    return drawn.join(salted, ["host", "salt"], kind).drop("salt")


def _tokens(page: str) -> dict[str, list[str]]:
    """Tags and words of a page by path."""
    by: dict[str, list[str]] = {}
    for path, tag, text, _, _, _ in html_pages.walk(page):
        held = by.get(path)
        if held is None:
            held = by[path] = []
        if tag is None:
            held += text.split()
        else:
            held.append(tag)
    return by


def _frequent(batches):
    """(host, token, held, pages): tokens on at least a quarter of a task's pages of a host, on how many of how many of them; the empty
    token stands for the pages themselves."""
    import pyarrow as pa

    pages: Counter[str] = Counter()
    seen: dict[str, dict[str, Counter[str]]] = defaultdict(dict)
    size = 0

    def out():
        rows = [(h, "", n, n) for h, n in pages.items()]
        rows += [(h, f"{p} {t}", k, pages[h]) for h, paths in seen.items() for p, held in paths.items() for t, k in held.items() if 4 * k >= pages[h]]
        pages.clear()
        seen.clear()
        for lo in range(0, len(rows), 20_000):
            h, t, k, n = zip(*rows[lo : lo + 20_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.string()), pa.array(t, pa.string()), pa.array(k, pa.int64()), pa.array(n, pa.int64())], names=["host", "token", "held", "pages"])

    for batch in batches:
        for h, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            pages[h] += 1
            own = seen[h]
            for path, tokens in _tokens(page).items():
                own.setdefault(path, Counter()).update(set(tokens))
                size += len(tokens)
            if size > 20_000_000:
                yield from out()
                size = 0
    yield from out()


def candidates(pages: DataFrame, how: Template) -> DataFrame:
    """(host, pages, tokens): tokens that may stand on ``share`` of a host's pages, at most some times the tokens of its mean page.

    A task that does not report a token holds it on less than a quarter of its pages, which bounds what the reports leave out.
    """
    reports = common.written(pages.mapInArrow(_frequent, "host string, token string, held long, pages long"), "reports")
    hosts = reports.filter("token = ''").groupBy("host").agg(F.sum("held").alias("all_pages")).filter(F.col("all_pages") >= how.pages)
    tokens = reports.filter("token <> ''").groupBy("host", "token").agg(F.sum("held").alias("held"), F.sum("pages").alias("pages"))
    may = F.col("held") + (F.col("all_pages") - F.col("pages")) / 4 >= F.col("all_pages") * how.share
    kept = tokens.join(hosts, "host").filter(may)
    return kept.groupBy("host").agg(F.first("all_pages").alias("pages"), F.sort_array(F.collect_list("token")).alias("tokens"))


def _by_path(tokens: list[str]) -> dict[str, dict[str, int]]:
    """Numbers of tokens by path and token."""
    by: dict[str, dict[str, int]] = defaultdict(dict)
    for i, t in enumerate(tokens):
        path, _, token = t.rpartition(" ")
        by[path][token] = i
    return by


def _skeletons(batches):
    """(host, page, at): a hash of the page, and the numbers of its candidates in order."""
    import pyarrow as pa

    known: dict[str, dict[str, dict[str, int]]] = {}
    none: dict[str, int] = {}
    for batch in batches:
        names, tokens = batch.column("host").to_pylist(), batch.column("tokens")
        keys, found = [], []
        for i, page in enumerate(batch.column("html").to_pylist()):
            h = names[i]
            if h not in known:
                known[h] = _by_path(tokens[i].as_py())
            by, at = known[h], []
            for path, tag, text, _, _, _ in html_pages.walk(page):
                own = by.get(path, none)
                if own:
                    at += [own[t] for t in ((tag,) if tag else text.split()) if t in own]
            raw = page.encode()
            keys.append(zlib.crc32(raw) | zlib.adler32(raw) << 31)
            found.append(at)
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(keys, pa.int64()), pa.array(found, pa.list_(pa.int32()))], names=["host", "page", "at"])


def _vectors(batches):
    """(host, token, low, high, held): sums over a task's pages of a hash of the page and of how often it holds the token."""
    import pyarrow as pa

    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        sizes = batch.column("size").to_pylist()
        for i, (h, key) in enumerate(zip(batch.column("host").to_pylist(), batch.column("page").to_pylist(), strict=True)):
            if h not in sums:
                sums[h] = np.zeros((3, sizes[i]), np.int64)
            count = np.bincount(batch.column("at")[i].values.to_numpy(zero_copy_only=False), minlength=sizes[i])
            at = np.flatnonzero(count)
            mixed = mix64(mix64(np.full(len(at), key, np.uint64)) + count[at].astype(np.uint64))
            sums[h][0, at] += (mixed & np.uint64(0xFFFFFFFF)).astype(np.int64)
            sums[h][1, at] += (mixed >> np.uint64(32)).astype(np.int64)
            sums[h][2, at] += 1
    for h, (low, high, held) in sums.items():
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array([h] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(low[at]), pa.array(high[at]), pa.array(held[at])], names=["host", "token", "low", "high", "held"])


PARTS = ("whole", "tags", "words")


def _orders(batches):
    """(host, class, part, first, bad): the order of a class on some page, and whether a page repeats it in another one; also of its
    tags and its words alone."""
    import pyarrow as pa

    known: dict[str, tuple[dict[int, int], dict[int, bool]]] = {}
    found: dict[tuple[str, int, int], tuple[list[int], bool]] = {}
    for batch in batches:
        for i, h in enumerate(batch.column("host").to_pylist()):
            if h not in known:
                members = batch.column("classes")[i].as_py()
                known[h] = ({t["token"]: t["class"] for t in members}, {t["token"]: t["tag"] for t in members})
            of, tag = known[h]
            runs: dict[tuple[int, int], list[int]] = defaultdict(list)
            for t in batch.column("at")[i].values.to_pylist():
                if t in of:
                    runs[of[t], 0].append(t)
                    runs[of[t], 1 if tag[t] else 2].append(t)
            for (c, part), run in runs.items():
                first = run[: len(set(run))]
                old, bad = found.get((h, c, part), (first, False))
                found[h, c, part] = (old, bad or old != first or len(run) % len(first) > 0 or first * (len(run) // len(first)) != run)
    rows = [(h, c, part, first, bad) for (h, c, part), (first, bad) in found.items()]
    names = ["host", "class", "part", "first", "bad"]
    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.bool_()))], names=names)


def crossings(page: list[int], place: dict[int, tuple[int, int]], sizes: dict[int, int]) -> set[tuple[int, int]]:
    """(loser, winner) of classes that are open when a class around them goes on: neither lies in a gap of the other. ``place``: class
    and place in its order of each token; the class of more tokens wins."""
    lost, stack = set(), []
    for t in page:
        if t not in place:
            continue
        c, k = place[t]
        if k:
            while stack and stack[-1] != c:
                other = stack.pop()
                a, b = sorted((c, other), key=lambda x: (sizes[x], -x))
                lost.add((a, b))
        else:
            stack.append(c)
        if stack and k + 1 == sizes[c]:
            stack.pop()
    return lost


def _crossed(batches):
    """(host, loser, winner), distinct in each task."""
    import pyarrow as pa

    known: dict[str, tuple] = {}
    found: set[tuple[str, int, int]] = set()
    for batch in batches:
        for i, h in enumerate(batch.column("host").to_pylist()):
            if h not in known:
                orders = [(t["class"] * 3 + t["part"], t["first"]) for t in batch.column("orders")[i].as_py()]
                known[h] = ({t: (c, k) for c, first in orders for k, t in enumerate(first)}, {c: len(first) for c, first in orders})
            found.update((h, a, b) for a, b in crossings(batch.column("at")[i].values.to_pylist(), *known[h]))
    rows = list(found)
    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int32(), pa.int32()))], names=["host", "loser", "winner"])


def templates(pages: DataFrame, how: Template = Template()) -> DataFrame:
    """(host, pages, template): tokens of the valid classes of each host with enough pages; a token is its path, a space, and a tag or a
    word. ``pages``: host and html, both not null."""
    hosts = common.written(candidates(pages, how), "candidates")
    length = F.aggregate(F.transform("tokens", F.length), F.lit(0), lambda a, b: a + b + 20)
    skeletons = with_hosts(pages, hosts.select("host", "tokens"), length, how).mapInArrow(_skeletons, "host string, page long, at array<int>")
    skeletons = common.written(skeletons, "skeletons")

    sized = with_hosts(skeletons, hosts.select("host", F.size("tokens").alias("size")), F.lit(60), how)
    vectors = sized.mapInArrow(_vectors, "host string, token int, low long, high long, held long")
    vectors = vectors.groupBy("host", "token").agg(*[F.sum(c).alias(c) for c in ("low", "high", "held")])
    named = hosts.select("host", "pages", F.posexplode("tokens").alias("token", "name"))
    vectors = vectors.join(named, ["host", "token"]).filter(F.col("held") >= F.col("pages") * how.share)
    tag = F.element_at(F.split("name", " "), -1).rlike("^</?[a-z]")
    member = F.struct("token", tag.alias("tag"))
    classes = vectors.groupBy("host", "low", "high", "held").agg(F.collect_list(member).alias("members")).filter(F.size("members") >= how.least)
    ranked = F.transform("all", lambda c, i: F.transform(c, lambda t: F.struct(t["token"].alias("token"), t["tag"].alias("tag"), i.cast("int").alias("class"))))
    classes = classes.groupBy("host").agg(F.sort_array(F.collect_list(F.sort_array("members"))).alias("all")).select("host", F.flatten(ranked).alias("classes"))
    classes = common.written(classes, "classes")

    orders = with_hosts(skeletons, classes, F.size("classes") * 12, how).mapInArrow(_orders, "host string, class int, part int, first array<int>, bad boolean")
    orders = orders.groupBy("host", "class", "part").agg(F.min("first").alias("first"), F.max("first").alias("other"), F.max("bad").alias("bad"))
    good = orders.filter((F.col("first") == F.col("other")) & ~F.col("bad") & (F.size("first") >= how.least))
    # a class in one order as a whole; of any other, its tags or its words that keep one
    whole = good.filter("part = 0").select("host", "class", F.lit(True).alias("whole"))
    good = good.join(whole, ["host", "class"], "left").filter("part = 0 or whole is null").select("host", "class", "part", "first")
    good = common.written(good, "orders")

    grouped = good.groupBy("host").agg(F.collect_list(F.struct("class", "part", "first")).alias("orders"))
    weight = F.aggregate("orders", F.lit(0), lambda a, o: a + 20 + 4 * F.size(o["first"]))
    lost = with_hosts(skeletons, grouped, weight, how).mapInArrow(_crossed, "host string, loser int, winner int")
    lost = lost.select("host", F.floor(F.col("loser") / 3).cast("int").alias("class"), F.pmod("loser", F.lit(3)).alias("part")).distinct()
    valid = good.join(lost, ["host", "class", "part"], "left_anti").select("host", F.explode("first").alias("token"))
    return valid.join(named, ["host", "token"]).groupBy("host").agg(F.first("pages").alias("pages"), F.sort_array(F.collect_list("name")).alias("template"))


BLOCK = "struct<slot: bigint, path: string, role: int, letters: bigint, linked: bigint, constant: boolean, text: string>"


def _blocks(batches):
    """Ids, host and blocks of every page, and the path that holds most text outside of links."""
    import pyarrow as pa

    known: dict[str, dict[str, frozenset[str]]] = {}
    slots: dict[str, int] = {}
    kinds = pa.struct([("slot", pa.int64()), ("path", pa.string()), ("role", pa.int32()), ("letters", pa.int64()), ("linked", pa.int64()), ("constant", pa.bool_()), ("text", pa.string())])
    for batch in batches:
        names, template = batch.column("host").to_pylist(), batch.column("template")
        found, dense = [], []
        for i, page in enumerate(batch.column("html").to_pylist()):
            h = names[i]
            if h not in known:
                known[h] = {p: frozenset(t) for p, t in _by_path(template[i].as_py() or []).items()}
            weight: Counter[str] = Counter()
            own = []
            for b in html_pages.blocks(page, known[h]):
                if b.last not in slots:
                    slots[b.last] = zlib.crc32(b.last.encode())
                own.append({"slot": slots[b.last], "path": b.path, "role": b.role, "letters": b.letters, "linked": b.linked, "constant": b.constant, "text": b.text})
                if b.role == html_pages.PLAIN_ROLE and not b.constant:
                    weight[b.path] += b.letters - 2 * b.linked
            found.append(own)
            dense.append(max(weight, key=lambda p: (weight[p], p)) if weight else None)
            if len(slots) > 200_000:
                slots.clear()
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("page_id", "url", "host")], pa.array(dense, pa.string()), pa.array(found, pa.list_(kinds))], names=["page_id", "url", "host", "dense", "blocks"])


def extract(pages: DataFrame, how: Template = Template(), page: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars, host, n_template (tokens of its host's template), n_constant (blocks left out as
    nothing but template).

    Main text are the blocks inside of an article or main element; of a page without one, the blocks below the path whose slots hold
    the most text of the host outside of links; of other pages, and of hosts of few pages, the path that holds the most on the page.
    Menus, headers, footers, sidebars, notices, adverts, forms and comments are told by elements and names. Blocks that are nothing but
    template are left out, unless such blocks are the larger part of a host's main text, as on hosts full of copies.

    A null or empty page has an empty text. A null or odd URL has no host and no template. Repeated pages and ids are rows of their
    own; an empty table gives no row. Other columns are not read.
    """
    rows = pages.select("page_id", "url", host().alias("host"), F.coalesce(F.col(page), F.lit("")).alias("html"))
    known = common.written(templates(rows.filter("host is not null").select("host", "html"), how), "templates")
    length = F.aggregate(F.transform("template", F.length), F.lit(0), lambda a, b: a + b + 20)
    blocked = with_hosts(rows, known.select("host", "template"), length, how, "left")
    blocked = common.written(blocked.mapInArrow(_blocks, f"page_id {dict(rows.dtypes)['page_id']}, url string, host string, dense string, blocks array<{BLOCK}>"), "blocks")

    each = blocked.filter("host is not null").select("host", F.explode("blocks").alias("b")).select("host", "b.*")
    slots = each.filter(f"role <> {html_pages.DROP_ROLE}").groupBy("host", "slot", "path", "role").agg(
        F.sum(F.when(~F.col("constant"), F.col("letters") - 2 * F.col("linked")).otherwise(0)).alias("free"),
        F.sum("letters").alias("letters"),
        F.sum(F.when(F.col("constant"), F.col("letters")).otherwise(0)).alias("constant"),
    )
    fullest = F.max_by(F.when(F.col("role") == html_pages.PLAIN_ROLE, F.col("path")), F.when((F.col("role") == html_pages.PLAIN_ROLE) & (F.col("free") > 0), F.struct("free", "path")))
    main = F.col("role") == html_pages.MAIN_ROLE
    decided = slots.groupBy("host").agg(
        fullest.alias("fullest"),
        F.sum(F.when(main, F.col("letters"))).alias("main"), F.sum(F.when(main, F.col("constant"))).alias("main_constant"),
        F.sum("letters").alias("letters"), F.sum("constant").alias("constant"),
    )
    copies = F.when(F.col("main") > 0, F.col("main_constant") * 2 > F.col("main")).otherwise(F.col("constant") * 2 > F.col("letters"))
    decided = decided.select("host", "fullest", F.coalesce(copies, F.lit(False)).alias("copies"))
    sizes = known.select("host", F.size("template").cast("long").alias("n_template"))
    decided = common.written(decided.join(sizes, "host"), "decided")
    out = with_hosts(blocked, decided, F.lit(200), how, "left")

    shown = F.filter("blocks", lambda b: b["role"] != html_pages.DROP_ROLE)
    inside = F.filter(shown, lambda b: b["role"] == html_pages.MAIN_ROLE)
    under = lambda path: F.filter(shown, lambda b: (b["path"] == path) | F.startswith(b["path"], F.concat(path, F.lit("/"))))
    chosen = F.when(F.size(inside) > 0, inside).when(F.col("fullest").isNotNull() & (F.size(under(F.col("fullest"))) > 0), under(F.col("fullest"))).when(F.col("dense").isNotNull(), under(F.col("dense")))
    out = out.withColumn("chosen", F.coalesce(chosen, F.array().cast(f"array<{BLOCK}>")))
    left = F.when(F.coalesce("copies", F.lit(True)), F.col("chosen")).otherwise(F.filter("chosen", lambda b: ~b["constant"]))
    out = out.withColumn("left", left)
    text = F.array_join(F.transform("left", lambda b: b["text"]), "\n\n")
    return out.select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"), "host", F.coalesce("n_template", F.lit(0)).alias("n_template"), (F.size("chosen") - F.size("left")).cast("long").alias("n_constant"))


def op13_html_extraction(spark, sf_dir: str) -> DataFrame:
    """All pages."""
    found = extract(common.table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", "n_chars", "n_template", "n_constant")
