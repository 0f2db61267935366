"""Records across splits: every cut of a text gives the same records."""

import csv
import io
import os
import random
import re
import tempfile

import pytest

from ledger_analytics.sources.files import read_delimited, read_registry, read_staging
from ledger_analytics.sources.records import QUOTED, RECORD, Reader, cut_records

AWKWARD = 'h;"two\nwords"\n1;"a ""b""\n;c"\n2;5" pipe\n"";\n"3\n\n";x"y\n4;"""";"\n"\n\n  \n5;é\r\n"6;\r\n7";8\n9;z'


def records_of(text, sep=";"):
    """The records of a text, character by character."""
    out, begin, state = [], 0, "record"
    for i, c in enumerate(text):
        if state == "quoted":
            state = "closing" if c == '"' else state
        elif c == '"' and state in ("record", "field", "closing"):
            state = "quoted"
        elif c == "\n":
            out.append(text[begin:i])
            begin, state = i + 1, "record"
        else:
            state = "field" if c == sep else "plain"
    out.append(text[begin:])
    return [r.removesuffix("\r") if i < len(out) - 1 else r for i, r in enumerate(out) if r.strip(" \r")], state == "quoted"


def unended(record):
    """Without the line break that a text may end with."""
    return re.sub("\r?\n?$", "", record, count=1)


def random_text(r, n):
    return "".join(r.choices(['"', ";", "\n", "a", "bc", '";"', '"\n', '""', "\r\n", " "], k=n))


def test_reader_steps_as_characters_do():
    r, reader = random.Random(1), Reader(";")
    for _ in range(500):
        text = random_text(r, r.randrange(30))
        cuts = []
        end = reader.over(text, RECORD, cuts)
        found = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        want, broken = records_of(text)
        assert [unended(x) for x in found if x.strip(" \r\n")] == [unended(x) for x in want]
        assert broken == (end == QUOTED)
        for cut in range(len(text)):  # states compose
            assert reader.over(text[cut:], reader.over(text[:cut], RECORD)) == end


def test_any_cut_gives_the_same_records(spark):
    r = random.Random(2)
    texts = {f"f{i}": random_text(r, r.randrange(5, 120)) for i in range(40)} | {"awkward": AWKWARD, "open": 'a;b\n1;"never\nends\n2;3\n', "empty": "", "blank": "\n \n\r\n"}
    for size in (1, 3, 50):
        pieces = [(p, b, at, t[at : min(at + 2, (b + 1) * size)]) for p, t in texts.items() for b in range(-(-len(t) // size))
                  for at in range(b * size, min(len(t), (b + 1) * size), 2)]
        df = spark.createDataFrame(pieces, "path string, block bigint, place bigint, value string").repartition(5, "path", "block").sortWithinPartitions("path", "block", "place")
        got = {}
        for x in sorted(cut_records(df.checkpoint(), ";").collect(), key=lambda x: (x.path, x.block, x.place)):
            got.setdefault(x.path, []).append(x)
        for p, t in texts.items():
            own = got.get(p, [])
            want, broken = records_of(t)
            values = [x.value for x in own]
            assert [unended(v) for v in values] == [unended(w) for w in want], (p, size)
            assert [x.broken for x in own] == [False] * (len(own) - 1) + [broken] * bool(own)


def test_long_records_stay_in_parts(spark, monkeypatch):
    from ledger_analytics.sources import records

    monkeypatch.setattr(records, "LONGEST_RECORD", 20)
    text = 'a;b\n1;"' + "x" * 60 + '"\n2;3\n'
    pieces = [("p", b, b * 10, text[b * 10 : b * 10 + 10]) for b in range(-(-len(text) // 10))]
    df = spark.createDataFrame(pieces, "path string, block bigint, place bigint, value string").coalesce(1).checkpoint()
    got = sorted(cut_records(df, ";").collect(), key=lambda x: x.place)
    assert [x.value for x in got if not x.broken] == ["a;b", "2;3"]
    assert "".join(x.value for x in got if x.broken).replace("\n", "") == '1;"' + "x" * 60 + '"'


def test_more_blocks_than_are_sent_are_joined(spark, monkeypatch):
    from ledger_analytics.sources import records

    monkeypatch.setattr(records, "SENT_BLOCKS", 0)
    pieces = [("p", i, i, c) for i, c in enumerate(AWKWARD)]
    df = spark.createDataFrame(pieces, "path string, block bigint, place bigint, value string").repartition(3, "block").sortWithinPartitions("block").checkpoint()
    got = sorted(cut_records(df, ";").collect(), key=lambda x: x.place)
    assert [x.value for x in got] == records_of(AWKWARD)[0]


@pytest.fixture
def small_splits(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


def written(name, text, encoding="utf-8"):
    root = tempfile.mkdtemp(prefix="ledger-test-")
    os.makedirs(f"{root}/a b%20é")
    path = f"{root}/a b%20é/{name}"
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return root, path


def account_text(n=300):
    r = random.Random(3)
    out = io.StringIO()
    w = csv.writer(out, delimiter=";", lineterminator="\r\n")
    rows = [(str(i), r.choice(["x", "two\nlines", 'say "hi"\n\n;', "é\r\nü", "long " * 60 + "\n"]), str(r.randrange(9))) for i in range(n)]
    w.writerows([("REG", "NAME", "V"), *rows])
    return out.getvalue(), rows


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "iso-8859-1", "utf-16"])
def test_files_are_read_in_splits(spark, small_splits, encoding):
    text, rows = account_text()
    _, path = written("r.csv", text, encoding)
    code = {"utf-8-sig": "UTF-8", "utf-8": "UTF-8"}.get(encoding, encoding)
    for df in (read_staging(spark, path, ["reg", "name", "v"], encoding=code), read_registry(spark, path, encoding=code).toDF("reg", "name", "v", "_corrupt_record", "reg_order")):
        got = df.orderBy("reg_order").collect()
        # Spark's own reader of whole files writes line breaks within values as LF
        assert [(x.reg, x.name, x.v) for x in got] == [(a, b.replace("\r\n", "\n") if encoding == "utf-16" else b, c) for a, b, c in rows]
        assert not any(x._corrupt_record for x in got)
        if encoding != "utf-16":
            assert len({x.reg_order.block for x in got}) > 20


def test_folder_with_and_without_line_breaks(spark, small_splits):
    text, rows = account_text()
    root, _ = written("1.csv", text)
    for name, own in (("2.csv", "V;REG;NAME\n1;a;\"b;c\"\n2;5\" pipe;d\n"), ("3.csv", "REG;NAME;V\n1;\"a\n2;b;c\n3;d;e\n"), ("4.csv", "REG;NAME;V\n1;\"a\nb\";2;too many\n3;d;e\n")):
        with open(f"{root}/{name}", "w") as f:
            f.write(own)
    got = read_delimited(spark, root).collect()
    of = lambda name: sorted((x.REG, x.NAME, x.V) for x in got if x.source_file == name and x._corrupt_record is None)
    assert of("1.csv") == sorted(rows)
    assert of("2.csv") == [("5\" pipe", "d", "2"), ("a", "b;c", "1")]
    assert of("3.csv") == [] and [x._corrupt_record for x in got if x.source_file == "3.csv"] == ['1;"a\n2;b;c\n3;d;e']
    assert of("4.csv") == [("3", "d", "e")] and [x._corrupt_record for x in got if x.source_file == "4.csv" and x._corrupt_record] == ['1;"a\nb";2;too many']
