"""The data source of read files against plain parsing."""

import gzip
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql.types import StructType

from curatrix.sources import reads


def make(n, seed, end="\n"):
    """Records whose qualities begin with @ and + as often as they may."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        size = rng.choice([0, 1, 2, 5, 30])
        out.append((f"@r{i} x", "".join(rng.choice("ACGTN") for _ in range(size)), rng.choice(["+", f"+r{i} x"]), "".join(rng.choice("@+I") for _ in range(size))))
    return out, "".join(end.join(r) + end for r in out)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [1, 7, 33, 100, 10_000])
def test_records_of_any_split(tmp_path, monkeypatch, end, size):
    monkeypatch.setattr(reads, "CHUNK", 50)
    want, text = make(60, size, end)
    text = text.removesuffix(end) if size == 33 else text
    p = tmp_path / "a.fq"
    p.write_text(text, newline="")
    got, begins = [], []
    for at in range(0, len(text), size):
        for begin, lines in reads.records(str(p), at, min(at + size, len(text))):
            got += [tuple(x.decode() for x in lines[k : k + 4]) for k in range(0, len(lines), 4)]
            begins += begin.tolist()
    assert got == want and begins == sorted(begins) and all(text[b] == "@" for b in begins)


def test_scan_of_plain_and_gzip_files(spark, tmp_path):
    a, text = make(300, 1)
    b, packed = make(50, 2)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.fq").write_text(text)
    with gzip.open(tmp_path / "in" / "b.fq.gz", "wt") as f:
        f.write(packed)
    with gzip.open(tmp_path / "in" / "b.fq.gz", "at") as f:  # two members
        f.write(make(3, 3)[1])
    (tmp_path / "in" / "_SUCCESS").write_text("")
    (tmp_path / "in" / "empty.fq").write_text("")
    folder = f"file://{tmp_path}/in"
    df = reads.with_ordinals(spark, folder, 500)
    got = sorted((r.path.rpartition("/")[2], r.ordinal, r.header, r.seq, r.plus, r.qual) for r in df.collect())
    assert got == sorted([("a.fq", i + 1, *r) for i, r in enumerate(a)] + [("b.fq.gz", i + 1, *r) for i, r in enumerate(b + make(3, 3)[0])])
    one = reads.scan_reads(spark, f"{tmp_path}/in/*.fq", ("seq",), 500)
    assert one.columns == ["seq"] and one.rdd.getNumPartitions() > 5 and sorted(r.seq for r in one.collect()) == sorted(r[1] for r in a)


@pytest.mark.parametrize("text", ["@r\nAC\n+\n", "@r\nAC\n+\nII\n\n", "r\nAC\n+\nII\n", "@r\nAC\n-\nII\n", "@r\nAC\n+\nI\n", "@r\nAC\n+\nII\n@s\nA"])
@pytest.mark.parametrize("packed", [False, True])
def test_cut_and_odd_records_raise(spark, tmp_path, text, packed):
    p = tmp_path / ("x.fq.gz" if packed else "x.fq")
    p.write_bytes(gzip.compress(text.encode()) if packed else text.encode())
    with pytest.raises(PySparkException):
        reads.scan_reads(spark, str(p), ("begin",)).count()


def test_absent_files_and_columns_raise(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        reads.files(str(tmp_path / "*.fq"))
    with pytest.raises(ValueError):
        reads.ReadReader({"path": "x"}, StructType().add("no", "string"))
