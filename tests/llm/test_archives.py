"""Archives, fill-in-the-middle and the Merkle manifest against brute force,
on odd rows and on no rows."""

import base64
import collections
import gzip
import hashlib
import os
import re
import zlib

import pytest
from pyspark.sql import functions as F

from salescope.llm import fill_middle, merkle, queries, warc
from salescope.llm.common import table
from salescope.session import scratch_path

SF = "/root/testdata/sf0.001"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def counted(df):
    return collections.Counter(tuple(r) for r in df.collect())


# ------------------------------------------------------------------ op12
TEXTS = [(1, "a\nb\nc\nd"), (1, "a\nb\nc\nd"), (2, None), (3, ""), (None, "x\n\ny é　\n"), (4, "\n"), (5, "no line end"), (6, "has <S> inside\nand more\n"),
         (7, "<\nS>\n<P\n>"), (8, "é𝄞\n" * 3000), (9, "one\r\ntwo\r\n"), (10, "z" * 200_000 + "\n" + "y" * 100_000), (-3, "q\nr\ns\n"), (11, "\x00\x0b\n \n")]


def middle(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string").withColumn("output", F.lit(1)).withColumn("form", F.lit("x")).withColumn("n", F.lit(None).cast("int"))


@pytest.mark.parametrize("rate,spm", [(100, 50), (60, 100), (100, 0)])
def test_fill_in_middle(spark, texts, rate, spm):
    recipe = fill_middle.Recipe(rate=rate, spm=spm)
    out = fill_middle.restore_texts(fill_middle.fill_in_middle(texts, recipe), recipe)
    rows = out.collect()
    assert collections.Counter(tuple(r)[:6] for r in rows) == collections.Counter(middle(*x, rate=rate, spm=spm) for x in TEXTS)
    assert collections.Counter((r["doc_id"], r["restored"]) for r in rows) == collections.Counter((k, t or "") for k, t in TEXTS)


def test_fill_in_middle_whole_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    got = counted(queries.op12_fill_in_middle(spark, SF))
    assert got == collections.Counter((*r[:5], sha(r[5]), sha(t or "")) for r, (_, t) in ((middle(*x), x) for x in docs))
    assert {r[2] for r in got} >= {"psm", "spm"}


@pytest.mark.parametrize("sizes", [(0, 0), (0, 3), (5, 0), (4, 7), (70_000, 200_001), (1, 65_537)])
def test_exchange(sizes):
    a, b = (os.urandom(n) for n in sizes)
    buf = bytearray(b"<" + a + b + b">")
    at = fill_middle.exchange(buf, 1, 1 + len(a), 1 + len(a) + len(b))
    assert bytes(buf) == b"<" + b + a + b">" and at == 1 + len(b)


def test_sentinels_are_checked(spark):
    with pytest.raises(ValueError):
        fill_middle.Recipe(prefix=b"<S>")
    with pytest.raises(ValueError):
        fill_middle.Recipe(prefix=b"aXb", suffix=b"bYa")
    with pytest.raises(ValueError):
        fill_middle.Recipe(middle=b"")
    none = spark.createDataFrame([], "doc_id long, text string")
    assert fill_middle.restore_texts(fill_middle.fill_in_middle(none)).count() == 0


# ------------------------------------------------------------------ op13
def tree(digests):
    """Levels of a tree: digests, then each level of runs of eight."""
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        run = i // 8 * 8
        out.append((level[run:i], level[i + 1:run + 8]))
        i //= 8
    return out


def leaf(row, text):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)])


def manifest(rows):
    langs = collections.defaultdict(list)
    for r in rows:
        langs[r["lang"]].append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        langs[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees[lang] = tree([leaf(r, r["text"]) for r in langs[lang]])
    top = tree([trees[x][-1][0] for x in order])
    out = collections.Counter()
    for j, lang in enumerate(order):
        for i, r in enumerate(langs[lang]):
            path = siblings(trees[lang], i) + siblings(top, j)
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and text is not None:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            fold = leaf(r, text)
            for left, right in path:
                fold = sha(*left, fold, *right)
            root = top[-1][0]
            out[(r["doc_id"], leaf(r, r["text"]), trees[lang][-1][0], root, sha(*[x for a, b in path for x in (*a, *b)]), fold, fold == root)] += 1
    return out


def test_merkle_whole_table(spark):
    rows = table(spark, SF, "documents").collect()
    got = counted(queries.op13_merkle_manifest(spark, SF))
    assert got == manifest(rows) and {r[-1] for r in got} == {True, False}


DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, lo int"


def _docs(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS)


@pytest.mark.parametrize("case", ["odd", "one", "sizes"])
def test_merkle_odd_rows(spark, case):
    rows = {
        "odd": [(1, "A", "en", "s", 1), (1, "A", "en", "s", 1), (1, "B", "en", None, None), (None, "n", "en", "s", 1), (None, "m", None, "", 0), (2, None, "", "s", 0),
                (3, "", None, "é", 0), (4, "É" * 50_000, "Z", "s", -1), (5, "x", "a", "s", 1), (6, "x", "é", "s", 1), (9, "HOT", "=", "s", 1)] + [(7, "Same", "en", "s", 4)] * 70,
        "one": [(3, "Only", None, "s", 4)],
        "sizes": [(i, f"T{i}", f"l{n}", "s", i) for n in (1, 7, 8, 9, 64, 65) for i in range(n)],
    }[case]
    df = _docs(spark, rows).repartition(5)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    claimed = F.when(hit, merkle.leaf_digest([*fields, F.translate("text", upper, upper.lower())])).otherwise(merkle.leaf_digest([*fields, F.col("text")]))
    got = merkle.verify_after(df, claimed).select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256), "folded_root", "verified")
    assert counted(got) == manifest([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in rows])


def test_merkle_nodes(spark):
    m = merkle.manifest(_docs(spark, [(i, "t", "en", "s", 1) for i in range(70)]), fan=4)
    nodes = {(r["part"], r["level"], r["lo"], r["hi"]): r["digest"] for r in m.nodes().collect()}
    assert ("lang", 4, 0, 70) in nodes and ("lang", 2, 64, 70) in nodes and ("top", 0, 0, 1) in nodes
    assert nodes[("lang", 1, 68, 70)] == sha(nodes[("lang", 0, 68, 69)], nodes[("lang", 0, 69, 70)])
    assert m.root().first()[0] == nodes[("lang", 4, 0, 70)]
    none = _docs(spark, [])
    assert merkle.verify_after(none, F.lit("x")).count() == 0 and merkle.manifest(none).root().count() == 0


# ------------------------------------------------------------------ op11
SAME = "<p>the same page</p>" * 40
PAGES = [(5, "http://a/5", SAME), (3, "http://a/3", SAME), (9, "http://a/9", SAME), (9, "http://b/9", SAME), (1, "http://a/1", None), (2, "http://a/2", ""),
         (4, None, "é𝄞\x00\r\n\r\nWARC/1.1"), (6, "http://a/ b\r\nWARC-Type: x\x7f ", "u"), (7, "http://a/7", "v" * 300_000), (None, "http://n/", "only null"),
         (None, "http://n/2", "only null"), (None, "http://n/3", SAME), (-8, "", "w"), (-(1 << 63), "http://least", "only null"), (8, "http://a/8", "u"), (8, "http://a/8", "u"),
         *[(20 + i, f"http://a/{i}", f"page {i} " * 50) for i in range(60)]]


def archived(rows, least=0):
    groups = collections.defaultdict(list)
    for i, (page, _, html) in enumerate(rows):
        groups[(html or "").encode()].append((page is None, page or 0, i))
    out = collections.Counter()
    for data, members in groups.items():
        members.sort()
        for j, (null, page, _) in enumerate(members):
            digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
            first = None if members[0][0] else members[0][1]
            revisit = j > 0 and len(data) >= least
            out[(None if null else page, len(data), digest, "revisit" if revisit else "response", first if revisit else None)] += 1
    return out


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("shard", F.lit("x")).withColumn("key", F.lit(1)).withColumn("payload", F.lit(0))


COLS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


@pytest.mark.parametrize("least", [0, 100])
def test_warc_odd_rows(spark, pages, least):
    path = scratch_path(spark, "warc-test")
    layout = warc.Layout(shard_bytes=6000, file_bytes=900, revisit_bytes=least)
    made = warc.write_warc(pages, path, layout).collect()
    assert len({r["shard"] for r in made}) > 5 and max(r["roll"] for r in made) > 0 and sum(r["records"] for r in made) == len(PAGES)
    back = warc.read_warc(spark, path)
    assert counted(back.select(COLS)) == archived(PAGES, least)
    rows = back.collect()
    assert len({r["record_id"] for r in rows}) == len(rows)
    whole = {r["record_id"]: r for r in rows if r["record_type"] == "response"}
    for r in rows:
        source = r if r["record_type"] == "response" else whole[r["refers_to_id"]]
        assert warc.sha1_base32(bytes(source["payload"])) == r["payload_digest"]
    assert collections.Counter(r["url"] for r in rows if r["page_id"] in (4, 6, -8)) == {None: 1, "http://a/ b%0D%0AWARC-Type: x%7F ": 1, "": 1}
    # any reader of gzip members finds the records, files do not pass their size by more than a record, order is by page
    ids = []
    for r in sorted(made, key=lambda r: r["name"]):
        raw = gzip.open(f"{warc.file_system(path)[1]}/archive/{r['name']}").read()
        assert raw.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
        ids += re.findall(rb"^WARC-Page-ID: (-?\d+)\r$", raw, re.M)
    assert [int(x) for x in ids] == sorted(int(x) for x in ids)


def test_warc_is_deterministic(spark, pages):
    """Neither how the input is split nor how many shuffle partitions there are changes a byte."""
    seen = []
    for parts, shuffles in ((1, 3), (7, 11)):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
        path = scratch_path(spark, "warc-same")
        seen.append({r["name"]: r["sha256"] for r in warc.write_warc(pages.repartition(parts), path, warc.Layout(shard_bytes=9000)).collect()})
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] and len(seen[0]) > 3


def test_warc_hot_page_shares_shards(spark, monkeypatch):
    """Rows alike in id and payload beyond a shard's size are dealt to several, with one response."""
    monkeypatch.setattr(warc, "DEALT_ROWS", 100)
    rows = [(1, "u", "x" * 100)] * 2000 + [(2, "u", "y")]
    path = scratch_path(spark, "warc-hot")
    made = warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), path, warc.Layout(shard_bytes=100_000)).collect()
    assert len(made) >= 8 and max(r["records"] for r in made) < 600
    assert counted(warc.read_warc(spark, path, payloads=False).select(COLS)) == archived(rows)


def test_warc_commit_and_damage(spark, pages):
    path = scratch_path(spark, "warc-commit")
    warc.write_warc(pages, path, warc.Layout(shard_bytes=20_000))
    root = warc.file_system(path)[1]
    assert not os.path.exists(f"{root}/temporary")
    with open(f"{root}/archive/part-999999-0000.warc.gz", "wb") as f:         # of a lost attempt: in no manifest
        f.write(b"x")
    assert counted(warc.commit(spark, path)) == counted(warc.commit(spark, path))
    assert warc.read_warc(spark, path, payloads=False).count() == len(PAGES)
    name = sorted(os.listdir(f"{root}/archive"))[0]
    data = open(f"{root}/archive/{name}", "rb").read()
    with open(f"{root}/archive/{name}", "wb") as f:
        f.write(gzip.compress(gzip.decompress(data).replace(b"the same page", b"the sane page")))
    with pytest.raises(Exception, match=name):
        warc.read_warc(spark, path).count()


def test_warc_no_rows(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.warc_round_trip(none).count() == 0


def test_warc_whole_table(spark):
    rows = [(r["page_id"], r["url"], r["html"]) for r in table(spark, SF, "pages").collect()]
    assert counted(queries.op11_warc(spark, SF)) == archived(rows)
