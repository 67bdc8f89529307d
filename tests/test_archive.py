import bz2
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from palimpsest.operators.framing import frame, with_offsets
from palimpsest.operators.index import IndexStore
from palimpsest.operators.metadata import latest_timestamp, metadata
from palimpsest.operators.shred import damages_of, in_namespaces, pages_of, revisions_of, rows_of
from palimpsest.plans.build import build
from palimpsest.sources.dump import list_dumps, opened, read_pages, read_siteinfo, unpack_7z
from palimpsest.sources.mwrev import append_frames, read_archive, records, slice_of, unframe, write_archives

XML = """<mediawiki><siteinfo><base>https://En.Wiki.Example/wiki/Main</base></siteinfo>
<page><title>A &amp; B</title><ns>0</ns><id>1</id>
<revision><id>10</id><timestamp>2024-01-01T00:00:00Z</timestamp><contributor><id>7</id><username>u</username></contributor><text>  one
two &lt;b&gt;
</text></revision>
<revision><id>11</id><parentid>10</parentid><timestamp>2024-01-02T00:00:00Z</timestamp><contributor><ip>1.2.3.4</ip></contributor><text/></revision></page>
<page><title>Talk:A</title><ns>1</ns><id>2</id><revision><id>12</id><timestamp></timestamp><text>t</text></revision></page>
<page><title>Empty</title><ns>0</ns><id>3</id></page>
<page><title></title><ns>0</ns><id>4</id></page>
<page><title>Bad</title><ns>x</ns><id>y</id><revision><id>z</id><parentid>q</parentid><timestamp>2024-01-03T00:00:00Z</timestamp><text>b</text></revision></page>
</mediawiki>"""


@pytest.fixture()
def dumps(tmp_path):
    (tmp_path / "a.xml").write_text(XML)
    data = XML.encode()
    (tmp_path / "b.xml.bz2").write_bytes(bz2.compress(data[:300]) + bz2.compress(data[300:]))
    (tmp_path / "note.txt").write_text("x")
    (tmp_path / "sub").mkdir()
    return str(tmp_path)


def test_listing(dumps):
    assert [os.path.basename(p) for p in list_dumps(dumps)] == ["a.xml", "b.xml.bz2"]


def test_shred(spark, dumps):
    read = read_pages(spark, list_dumps(dumps))
    raw = rows_of(read)
    assert {(r["file"], r["page_raw"], r["pos"]) for r in raw.filter("pos < 0").collect()} == {(f, "3", -1) for f in ("a.xml", "b.xml.bz2")} | {(f, "4", -1) for f in ("a.xml", "b.xml.bz2")}
    pages = {(r["file"], r["page_id"]): (r["ns"], r["title"]) for r in pages_of(raw).collect()}
    assert pages["b.xml.bz2", 1] == (0, "A & B") and pages["a.xml", 3] == (0, "Empty") and pages["a.xml", 0] == (0, "Bad") and ("a.xml", 4) not in pages
    revs = {(r["file"], r["rev_raw"]): r for r in revisions_of(raw).collect()}
    assert revs["a.xml", "10"]["text"] == "one\ntwo <b>" and revs["a.xml", "10"]["user_raw"] == "7"
    assert revs["b.xml.bz2", "11"]["text"] == "" and revs["b.xml.bz2", "11"]["user_raw"] == "0" and revs["b.xml.bz2", "11"]["parent_rev_id"] == 10
    bad = revs["a.xml", "z"]
    assert (bad["rev_id"], bad["parent_rev_id"], bad["page_id"], bad["ns"], bad["ns_raw"]) == (0, None, 0, 0, "x")
    assert revisions_of(rows_of(in_namespaces(read, ["1"]))).count() == 2
    assert revisions_of(rows_of(in_namespaces(read, []))).count() == 0
    kept = revisions_of(rows_of(read_pages(spark, list_dumps(dumps), preserve_text=True))).filter("rev_raw = '10'").first()
    assert kept["text"].startswith("  one")


def test_siteinfo(spark, dumps):
    assert {tuple(r)[:2] for r in read_siteinfo(spark, list_dumps(dumps)).collect()} == {("a.xml", "en.wiki.example"), ("b.xml.bz2", "en.wiki.example")}
    assert {r["domain"] for r in read_siteinfo(spark, list_dumps(dumps), "x.org").collect()} == {"x.org"}
    assert read_pages(spark, []).count() == 0 and read_siteinfo(spark, []).count() == 0


def test_7z(spark, tmp_path):
    jvm = spark.sparkContext._jvm
    src = tmp_path / "in.xml"
    src.write_text(XML)
    out = jvm.org.apache.commons.compress.archivers.sevenz.SevenZOutputFile(jvm.java.io.File(str(tmp_path / "c.xml.7z")))
    entry = out.createArchiveEntry(jvm.java.io.File(str(src)), "in.xml")
    out.putArchiveEntry(entry)
    out.write(bytearray(XML.encode()))
    out.closeArchiveEntry()
    out.close()
    packed = str(tmp_path / "c.xml.7z")
    (staged,) = unpack_7z(spark, [packed], str(tmp_path / "stage"))
    assert open(staged).read() == XML and os.path.basename(staged) == "c.xml.7z" and os.listdir(tmp_path / "stage") == ["c.xml.7z"]
    with opened(packed) as f:
        assert f.read(10).decode() == XML[:10] and f.read().decode() == XML[10:]
    assert [tuple(r)[:2] for r in read_siteinfo(spark, [packed]).collect()] == [("c.xml.7z", "en.wiki.example")]
    os.remove(src)
    build(spark, str(tmp_path), str(tmp_path / "o1"))
    build(spark, str(tmp_path), str(tmp_path / "o2"), large_pages=True)
    assert len(list(records(str(tmp_path / "o1" / "c.xml.mwrev.zst")))) == 4
    assert list(records(str(tmp_path / "o1" / "c.xml.mwrev.zst"))) == list(records(str(tmp_path / "o2" / "c.xml.mwrev.zst"))) and sorted(os.listdir(tmp_path / "o1")) == ["c.xml.mwrev.zst"]


@pytest.mark.parametrize("method", ["COPY", "LZMA", "LZMA2", "BZIP2"])
def test_7z_methods(spark, tmp_path, method):
    from palimpsest.sources.sevenzip import open_7z

    jvm = spark.sparkContext._jvm
    seven, data = jvm.org.apache.commons.compress.archivers.sevenz, os.urandom(50_000) + b"ab" * 900_000
    out = seven.SevenZOutputFile(jvm.java.io.File(str(tmp_path / "x.7z")))
    try:
        out.setContentCompression(getattr(seven.SevenZMethod, method))
        for name, part in (("a", data), ("b", b"other")):
            e = out.createArchiveEntry(jvm.java.io.File(str(tmp_path / "x.7z")), name)
            out.putArchiveEntry(e)
            out.write(bytearray(part))
            out.closeArchiveEntry()
    finally:
        out.close()
    with open_7z(str(tmp_path / "x.7z")) as f:
        assert f.read() == data
    (tmp_path / "cut.7z").write_bytes((tmp_path / "x.7z").read_bytes()[:40])
    with pytest.raises((ValueError, EOFError)):
        open_7z(str(tmp_path / "cut.7z"))


def test_build_places_every_text(spark, dumps, tmp_path):
    out = str(tmp_path / "out")
    build(spark, dumps, out, index=out + "/index")
    back = {(r["file"], r["rev_id"]): r for r in read_archive(spark, out).collect()}
    assert len(back) == 8
    store = IndexStore(spark, out + "/index")
    bundles = {r["id"]: r["file_path"] for r in store.read("revision_bundles").collect()}
    assert sorted(bundles.values()) == ["a.mwrev.zst", "b.xml.mwrev.zst"]
    for r in store.read("revisions").filter("revision_id = 10").collect():
        assert slice_of(f"{out}/{bundles[r['found_in_bundle']]}", r["offset_begin"], r["length"]) == b" one\n two <b>\n"
    assert {r["title"] for r in store.read("documents").collect()} == {"A & B", "Talk:A", "Empty", "Bad"}
    web = store.read("web_resources").collect()
    assert len(web) == 4 and all(w["instance_of_document"] and w["url"].startswith("https://en.wiki.example/w/index.php?curid=") for w in web)
    build(spark, dumps, out, index=out + "/index")  # again: nothing changes
    assert IndexStore(spark, out + "/index").read("revisions").count() == store.read("revisions").count()


def test_one_scan_of_the_dumps(spark, dumps, tmp_path, monkeypatch):
    """The XML is parsed once, whatever is made from it."""
    from palimpsest.sources import dump

    jvm, out = spark.sparkContext._jvm, str(tmp_path / "out")
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    build(spark, dumps, out, index=out + "/index")
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    plans = [e.physicalPlanDescription() for e in jvm.scala.jdk.javaapi.CollectionConverters.asJava(store.executionsList(before, 10_000))]
    assert len(plans) > 5 and sum("Scan xml" in p for p in plans) == 1, [p for p in plans if "Scan xml" in p]
    assert dump.base_of(dumps + "/b.xml.bz2") == "https://En.Wiki.Example/wiki/Main"


def test_build_to_stdout(spark, dumps):
    got = "".join(r["record"] for r in build(spark, dumps + "/a.xml").collect())
    assert got.startswith("# page_id=1 ns=0 rev_id=10 parent_rev_id= timestamp=2024-01-01T00:00:00Z user_id=7\n one\n two <b>\n# page_id=1 ns=0 rev_id=11 parent_rev_id=10")


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="\r"), max_size=40), min_size=1, max_size=6))
def test_round_trip(spark, tmp_path_factory, texts):
    out = str(tmp_path_factory.mktemp("rt"))
    rows = [("f", 0, i, "1", "0", str(i), "", "t", "0", t) for i, t in enumerate(texts)]
    revs = spark.createDataFrame(rows, "file string, page_seq long, pos int, page_raw string, ns_raw string, rev_raw string, parent_raw string, timestamp string, user_raw string, text string")
    framed = frame(revs.withColumn("seq", F.col("pos")).withColumn("file_path", F.concat("file", F.lit(".mwrev.zst"))))
    write_archives(framed, out)
    places = {r["seq"]: r for r in with_offsets(framed, ["seq"]).collect()}
    for rec, t in zip(records(f"{out}/f.mwrev.zst"), texts, strict=True):
        assert (rec[8], rec[9]) == (places[rec[1]]["offset_begin"], places[rec[1]]["length"])
        want = t.removesuffix("\n")
        assert rec[10] == ("".join(" " + x + "\n" for x in want.split("\n")) if t else "")
        assert slice_of(f"{out}/f.mwrev.zst", rec[8], rec[9]).decode() == rec[10]


def test_appended_frames(tmp_path, spark):
    path = str(tmp_path / "d" / "x.mwrev.zst")
    head = "# page_id=1 ns=0 rev_id={} parent_rev_id=0 timestamp=t user_id=0\n"
    first = append_frames([(head.format(1), " a\n")], path)
    size, stored = sum(first[0][:2]), sum(first[0][2:])
    append_frames([(head.format(9), " left over\n")] * 3, path, size, stored)  # never committed
    second = append_frames([(head.format(2), " b\n c\n")], path, size, stored)
    assert slice_of(path, *second[0][:2]) == b" b\n c\n" and second[0][2] == first[0][2] + first[0][3]
    assert [r[4] for r in records(path)] == ["1", "2"]
    assert {unframed["x"] for unframed in read_archive(spark, str(tmp_path)).select(unframe(F.col("body")).alias("x")).collect()} == {"a", "b\nc"}


def test_latest_timestamp_normalizes_before_comparing(spark):
    rows = [(1, None, 10, "p", 0, 100, "2026-05-31T23:59:54Z"), (2, 1, 10, "p", 100, 120, "2026-05-31 23:59:55"), (3, 2, 10, "p", 1, 1, "zzz"), (4, 2, 10, "p", 1, 1, None)]
    revs = spark.createDataFrame(rows, "rev_id long, parent_rev_id long, page_id long, file_path string, offset_begin long, length long, timestamp string")
    pages = spark.createDataFrame([(10, 0, "T")], "page_id long, ns int, title string")
    m = metadata(pages, revs)
    assert latest_timestamp(m).first()[0] == "2026-05-31T23:59:55Z"
    assert m.filter("type = 'page'").first()["rev_id"] is None and m.count() == 5
    assert latest_timestamp(m.limit(0)).first()[0] is None


def test_streamed_history_equals_row_tags(spark, dumps):
    from palimpsest.sources.history import read_history

    paths = list_dumps(dumps)
    rows = read_history(spark, paths)
    cols = ["file", "pos", "page_raw", "ns_raw", "rev_raw", "parent_raw", "timestamp", "user_raw", "text", "rev_id", "parent_rev_id", "page_id", "ns", "file_path"]
    one = sorted(map(tuple, revisions_of(rows_of(read_pages(spark, paths))).select(*cols).collect()), key=str)
    assert sorted(map(tuple, revisions_of(rows).select(*cols).collect()), key=str) == one and len(one) == 8
    assert sorted(map(tuple, pages_of(rows).collect())) == sorted(map(tuple, pages_of(rows_of(read_pages(spark, paths))).collect()))
    assert revisions_of(read_history(spark, paths, ["1"])).count() == 2 and read_history(spark, []).count() == 0


def test_damaged_end_keeps_what_came_before(spark, tmp_path):
    from palimpsest.sources.history import read_history

    (tmp_path / "t.xml").write_text(XML[: XML.index("<page><title>Empty")] + "<page><title>X</title><ns>0</ns><id>9</id><revision><id>5")
    rows = read_history(spark, [str(tmp_path / "t.xml")])
    assert {r["page_raw"] for r in rows.filter("pos >= -1").collect()} == {"1", "2"} and revisions_of(rows).count() == 3
    assert rows.filter("pos = -2").first()["text"].startswith("ParseError: ")
    (tmp_path / "t.xml").rename(tmp_path / "u.xml")
    build(spark, str(tmp_path), str(tmp_path / "o"), large_pages=True)
    assert len(list(records(str(tmp_path / "o" / "u.mwrev.zst")))) == 3
    assert [(r["file"], r["message"][:10]) for r in spark.read.parquet(str(tmp_path / "o" / "_damages")).collect()] == [("u.xml", "ParseError")]
    assert read_pages(spark, [str(tmp_path / "u.xml")]).filter("id IN ('1', '2')").count() == 2
    (tmp_path / "v.xml").write_text(XML.replace("<title>Talk:A</title>", "<title>Talk:A</ttle>"))
    for name in ("u.xml", "v.xml"):
        rows = rows_of(read_pages(spark, [str(tmp_path / name)])).withColumn("message", F.col("text"))
        assert [(r["file"], r["message"]) for r in damages_of(rows).collect()] == [(name, "page could not be parsed")] and "A & B" in [r["title"] for r in rows.collect()]
    os.remove(tmp_path / "u.xml")
    build(spark, str(tmp_path), str(tmp_path / "o2"), ["0"])
    assert spark.read.parquet(str(tmp_path / "o2" / "_damages")).count() == 1


def test_large_pages_build(spark, dumps, tmp_path):
    a, b = str(tmp_path / "o1"), str(tmp_path / "o2")
    build(spark, dumps, a)
    build(spark, dumps, b, large_pages=True)
    for name in ("a.mwrev.zst", "b.xml.mwrev.zst"):
        assert list(records(f"{a}/{name}")) == list(records(f"{b}/{name}"))


def test_sqlite_index(spark, dumps, tmp_path):
    from palimpsest.sources.sqlite import KEYS, read_sqlite, write_sqlite

    out, db = str(tmp_path / "out"), str(tmp_path / "index.db")
    build(spark, dumps, out, index=out + "/index")
    store = IndexStore(spark, out + "/index")
    tables = {t: store.read(t) for t in KEYS}
    write_sqlite(tables, db)
    write_sqlite(tables, db)  # merging again changes nothing
    for t, df in tables.items():
        assert sorted(map(tuple, read_sqlite(spark, db, t).collect()), key=str) == sorted(map(tuple, df.collect()), key=str), t
    moved = tables["web_resources"].withColumn("numeric_namespace_id", F.lit(9).cast("long")).withColumn("instance_of_document", F.lit(None).cast("long"))
    write_sqlite({"web_resources": moved}, db)
    got = read_sqlite(spark, db, "web_resources").collect()
    assert all(r["numeric_namespace_id"] == 9 and r["instance_of_document"] for r in got)
    with pytest.raises(Exception, match="unable to open|PYTHON_DATA_SOURCE"):
        read_sqlite(spark, str(tmp_path / "none.db"), "domains").collect()


def test_pages_wait_for_their_domain(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "i"))
    pages = spark.createDataFrame([("f", 1, 0, "T", 1)], "file string, page_id long, ns int, title string, seq long")
    none = spark.createDataFrame([], "file_path string, rev_id long, page_id long, offset_begin long, length long, parent_rev_id long, timestamp string")
    site = spark.createDataFrame([("f", "x.org")], "file string, domain string")
    store.apply(pages, none, site.limit(0))
    assert store.read("web_resources").count() == 0 and store.read("rejected_pages").count() == 1
    store.apply(pages.limit(0), none, site)
    assert store.read("web_resources").first()["url"] == "https://x.org/w/index.php?curid=1" and store.read("rejected_pages").count() == 0


def test_only_changed_resources_are_written(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "i"))
    site = spark.createDataFrame([("f", "x.org")], "file string, domain string")
    none = spark.createDataFrame([], "file_path string, rev_id long, page_id long, offset_begin long, length long, parent_rev_id long, timestamp string")
    pages = lambda *rows: spark.createDataFrame([("f", *r) for r in rows], "file string, page_id long, ns int, title string, seq long")
    store.apply(pages((1, 0, "A", 1), (2, 0, "B", 2), (3, 0, "C", 3)), none, site)
    store.apply(pages((2, 4, "B", 1), (3, 0, "C", 1), (4, 0, "D", 2)), none, site)
    parts = store._pointer()["web_resources"]
    assert [spark.read.parquet(str(tmp_path / "i" / p)).count() for p in parts] == [3, 2]  # the moved page and the new one
    got = {r["numeric_page_id"]: (r["id"], r["numeric_namespace_id"], r["instance_of_document"] is not None) for r in store.read("web_resources").collect()}
    assert got[2][1] == 4 and got[1][1] == 0 and len(got) == 4 and len({v[0] for v in got.values()}) == 4 and all(v[2] for v in got.values())


def test_merges_at_once_start_over(spark, tmp_path, monkeypatch):
    a, b = IndexStore(spark, str(tmp_path / "i")), IndexStore(spark, str(tmp_path / "i"))
    site = spark.createDataFrame([("f", "x.org")], "file string, domain string")
    revs = lambda k: spark.createDataFrame([("a", k, 1, k, 1, None, "t")], "file_path string, rev_id long, page_id long, offset_begin long, length long, parent_rev_id long, timestamp string")
    pages = spark.createDataFrame([("f", 1, 0, "T", 1)], "file string, page_id long, ns int, title string, seq long")
    commit, turns = a.commit, []

    def late(*args):
        turns.append(1)
        if len(turns) == 1:
            b.apply(pages, revs(2), site)
        commit(*args)

    monkeypatch.setattr(a, "commit", late)
    a.apply(pages, revs(1), site)
    assert len(turns) == 2 and sorted(r["revision_id"] for r in a.read("revisions").collect()) == [1, 2]
    assert a.read("documents").count() == a.read("web_resources").count() == a.read("revision_bundles").count() == 1


def test_index_parts_are_compacted(spark, tmp_path, monkeypatch):
    from palimpsest.operators import index

    monkeypatch.setattr(index, "MOST_PARTS", 2)
    store = IndexStore(spark, str(tmp_path / "i"))
    site = spark.createDataFrame([("f", "x.org")], "file string, domain string")
    for k in range(1, 5):
        pages = spark.createDataFrame([("f", k % 3, 0, f"T{k}", k)], "file string, page_id long, ns int, title string, seq long")
        revs = spark.createDataFrame([("a", k, k % 3, k, 1, None, "t"), ("a", 1, 9, 9, 9, None, "again")], "file_path string, rev_id long, page_id long, offset_begin long, length long, parent_rev_id long, timestamp string")
        store.apply(pages, revs, site)
        assert len(store._pointer()["revisions"]) <= 2 and len(store._pointer()["web_resources"]) <= 2
    assert sorted(r["revision_id"] for r in store.read("revisions").collect()) == [1, 2, 3, 4]
    assert store.read("revisions").filter("revision_id = 1").first()["offset_begin"] == 1
    ids = [r["id"] for r in store.read("documents").collect()]
    assert sorted(ids) == [1, 2, 3, 4] and store.read("domains").count() == 1 and store.read("web_resources").count() == 3


# --- a database server ---


class Busy(Exception):
    sqlstate = "40P01"


@pytest.fixture()
def server(tmp_path):
    """A stand-in for the server: DB-API connections to a file, which takes the same statements; ``fails`` deadlocks so many times."""
    import sqlite3

    from palimpsest.sources.sqlite import KEYS, ddl

    path, state = str(tmp_path / "server.db"), {"fails": 0, "error": Busy("deadlock detected")}
    with sqlite3.connect(path) as db:
        for t in ("containers", *KEYS):
            db.execute(ddl(t))

    class Connection:
        def __init__(self):
            self.db = sqlite3.connect(path)
            self.cursor, self.rollback, self.close = self.db.cursor, self.db.rollback, self.db.close

        def commit(self):
            if state["fails"]:
                state["fails"] -= 1
                raise state["error"]
            self.db.commit()

    def stage(df, name):
        with sqlite3.connect(path) as db:
            db.execute(f"DROP TABLE IF EXISTS {name}")
            db.execute(f"CREATE TABLE {name} ({', '.join(df.columns)})")
            db.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(df.columns))})", [tuple(r) for r in df.collect()])

    return Connection, stage, state


def test_server_merges(spark, dumps, tmp_path, server):
    from palimpsest.sources import postgres
    from palimpsest.sources.sqlite import KEYS

    connect, stage, state = server
    out = str(tmp_path / "out")
    build(spark, dumps, out, index=out + "/index")
    tables = {t: IndexStore(spark, out + "/index").read(t) for t in KEYS}
    db = connect().db
    with db:  # the server has rows and ids of its own
        db.execute("INSERT INTO domains (id, value) VALUES (40, 'other.org'), (41, 'en.wiki.example')")
        db.execute("INSERT INTO documents (id, title) VALUES (90, 'Empty')")
    state["fails"] = 2
    assert postgres.merge_tables(tables, connect, stage) == 3  # two deadlocks, then it goes through, once
    assert postgres.merge_tables(tables, connect, stage) == 1
    ask = lambda sql: sorted(db.execute(sql).fetchall())
    assert ask("SELECT DISTINCT domain_id FROM web_resources") == [(41,)] and ask("SELECT count(*) FROM domains") == [(2,)]
    local = {r["id"]: r["title"] for r in tables["documents"].collect()}
    assert ask("SELECT url_hash, title FROM web_resources w JOIN documents d ON d.id = instance_of_document") == sorted((r["url_hash"], local[r["instance_of_document"]]) for r in tables["web_resources"].collect())
    assert ask("SELECT id FROM documents WHERE title = 'Empty'") == [(90,)]
    files = {r["id"]: r["file_path"] for r in tables["revision_bundles"].collect()}
    want = sorted((r["revision_id"], files[r["found_in_bundle"]], r["offset_begin"], r["length"]) for r in tables["revisions"].collect())
    assert ask("SELECT revision_id, file_path, offset_begin, length FROM revisions JOIN revision_bundles b ON b.id = found_in_bundle") == want and len(want) > 2
    assert db.execute("SELECT count(*) FROM sqlite_master WHERE name LIKE 'staged%'").fetchone()[0] == 0
    assert postgres.known_ids(connect, [10, 11, 99] + list(range(1000, 1600))) == {10, 11} and postgres.latest(connect) == "2024-01-03T00:00:00Z"
    store = IndexStore(spark, out + "/index")
    state0 = store.state()
    new = {t: df.count() for t, df in store.since({}).items()}
    assert new == {t: df.count() for t, df in tables.items()} and not any(df.count() for t, df in store.since(state0).items() if t != "domains")
    state["fails"], state["error"] = 1, ValueError("something else")
    moved = tables["domains"].withColumn("value", F.lit("z.org"))
    with pytest.raises(ValueError):
        postgres.merge_tables({"domains": moved.withColumn("id", F.lit(77).cast("long"))}, connect, stage)
    state["fails"], state["error"] = 9, Busy("deadlock detected")
    with pytest.raises(Busy):
        postgres.merge_tables({"domains": moved.withColumn("id", F.lit(77).cast("long"))}, connect, stage)
    assert db.execute("SELECT count(*) FROM domains WHERE value = 'z.org'").fetchone()[0] == 0


def test_server_settings_and_tables():
    from palimpsest.sources import postgres

    assert postgres.settings({}) is None and postgres.settings({"DATABASE": "sqlite"}) is None
    env = {"DATABASE": "postgres", "DB_HOST": "h", "DB_PORT": "5", "DB_NAME": "n", "DB_USER": "u", "DB_PASS": "p"}
    assert postgres.jdbc(postgres.settings(env))[0] == "jdbc:postgresql://h:5/n"
    with pytest.raises(ValueError, match="DB_PASS"):
        postgres.settings({k: v for k, v in env.items() if k != "DB_PASS"})

    class Cursor:
        execute = staticmethod(lambda sql: None)
        fetchall = staticmethod(lambda: [("documents",), ("domains",)])

    db = type("D", (), {"cursor": lambda self: Cursor, "close": lambda self: None})
    with pytest.raises(RuntimeError, match="containers, web_resources, revision_bundles, revisions"):
        postgres.check_tables(db)
