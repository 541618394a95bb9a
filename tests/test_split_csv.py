"""CSV files with quoted newlines, read over byte ranges: equal to the read of whole files."""

import os
import random

import numpy as np
import pytest

from reviewlens.sources import split_csv
from reviewlens.sources.csv import read_reviews_csv, write_reviews_csv
from reviewlens.sources.fixtures import reviews_view

from conftest import SF_SMALL

HEADER = "review_id,reviewer,rating,review_summary,review_detail,helpful_str"


@pytest.fixture()
def small_ranges(spark):
    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield use
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def write(folder, name, text):
    with open(os.path.join(folder, name), "w", newline="", encoding="utf-8") as f:
        f.write(text)
    return os.path.join(folder, name)


def rows(spark, path, **how):
    df = read_reviews_csv(spark, path, corrupt=True, extra=True, **how)
    return df.columns, sorted((tuple(r) for r in df.collect()), key=repr)


def quoted(text):
    return '"' + text.replace('"', '""') + '"'


def made(seed, n=300, end="\n"):
    """Records with line ends, doubled quotes, delimiters, blanks and quotes inside unquoted values."""
    rng = random.Random(seed)
    bits = ["a", "word", " ", ",", '"', '""', end, end + end, "é", "日本", '",', '"' + end, "7"]
    out = [HEADER]
    for i in range(n):
        values = [quoted("".join(rng.choices(bits, k=rng.choice([0, 1, 3, 12, 60])))) for _ in range(2)]
        odd = rng.choice(["plain", 'in"side', 'two "quotes" here', "", '5" disk'])
        fields = [str(i), odd, str(i % 10), *values, quoted(f"{i},{i % 3}")]
        if i % 17 == 0:
            fields = fields[: rng.choice([1, 4])] if i % 2 else [*fields, "more", quoted("x" + end)]
        out.append(",".join(fields))
        out += [""] * (i % 29 == 0)
    return end.join(out) + end * (seed % 2)


@pytest.mark.parametrize("seed, ranges, end", [(1, 50, "\n"), (2, 11, "\n"), (3, 9, "\r\n"), (4, 40, "\r\n")])
def test_equals_whole_files(spark, tmp_dir, small_ranges, seed, ranges, end):
    path = write(tmp_dir, "a.csv", made(seed, end=end))
    want = rows(spark, path)
    small_ranges(os.path.getsize(path) // ranges)
    assert spark.read.text(path).rdd.getNumPartitions() > 3
    assert rows(spark, path, split=True) == want


def test_one_large_quoted_file_is_read_by_many_tasks(spark, tmp_dir, small_ranges):
    text = HEADER + "\n" + "".join(f'{i},r{i % 50},{i % 10},"sum, {i}","line\n\n{i} ""q""","{i % 7},{i % 3}"\n' for i in range(20000))
    path = write(tmp_dir, "big.csv", text)
    whole = read_reviews_csv(spark, path)
    small_ranges(100000)
    split = read_reviews_csv(spark, path, split=True)
    assert split.rdd.getNumPartitions() >= 10
    assert split.count() == 20000 and split.exceptAll(whole).count() == 0


def test_a_record_over_many_ranges(spark, tmp_dir, small_ranges):
    long = "\n".join(f'line {i} "said", {i}' for i in range(2000))
    text = f"{HEADER}\n1,a,2,s,{quoted(long)},\n2,b,3,t,{quoted(long)},\n3,c,4,u,v,\n"
    path = write(tmp_dir, "a.csv", text)
    small_ranges(1500)
    got = {r.review_id: (r.reviewer, r.review_detail) for r in read_reviews_csv(spark, path, split=True).collect()}
    assert got == {1: ("a", long), 2: ("b", long), 3: ("c", "v")}


def test_files_with_their_own_headers(spark, tmp_dir, small_ranges):
    write(tmp_dir, "a.csv", "reviewer,rating,review_summary\nann,8,ok\n")
    write(tmp_dir, "b.csv", '﻿Rating,review_summary,Reviewer,color\r\n3,"no\r\nyes",bob,red\r\n')
    write(tmp_dir, "c.csv", "reviewer\ncid")
    write(tmp_dir, "d.csv", "")
    write(tmp_dir, "e.csv", "reviewer,rating\rdan,5\reve,6\r")  # line ends of one kind only
    write(tmp_dir, "f.csv", 'reviewer,"two\nlines"\nfay,blue\n')
    df = read_reviews_csv(spark, tmp_dir, split=True, extra=True)
    got = {(r.reviewer, r.rating, r.review_summary, r.color, r["two\nlines"]) for r in df.collect()}
    assert got == {
        ("ann", 8.0, "ok", None, None),
        ("bob", 3.0, "no\nyes", "red", None),
        ("cid", None, None, None, None),
        ("dan", 5.0, None, None, None),
        ("eve", 6.0, None, None, None),
        ("fay", None, None, None, "blue"),
    }


def test_no_records(spark, tmp_dir):
    path = write(tmp_dir, "a.csv", "")
    assert read_reviews_csv(spark, path, split=True).collect() == []
    path = write(tmp_dir, "b.csv", HEADER + "\n")
    assert read_reviews_csv(spark, path, split=True).collect() == []


def test_a_quote_never_closed(spark, tmp_dir, small_ranges):
    path = write(tmp_dir, "a.csv", 'reviewer,review_summary\nann,ok\nbob,"never\n' + "closed,x\n" * 200)
    want = rows(spark, path)
    small_ranges(300)
    got = rows(spark, path, split=True)
    assert got[0] == want[0] and len(got[1]) == len(want[1]) == 2


def test_states_joined_without_broadcast(spark, tmp_dir, small_ranges):
    path = write(tmp_dir, "a.csv", made(5))
    small_ranges(os.path.getsize(path) // 20)
    few, many = (split_csv.csv_records(spark, path, most_ranges=n)[0] for n in (10**6, 0))
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect())) != []


def test_other_ranges_than_planned_raise(spark, tmp_dir, small_ranges):
    path = write(tmp_dir, "a.csv", made(6))
    size = os.path.getsize(path)
    small_ranges(size // 20)
    df = read_reviews_csv(spark, path, split=True)
    small_ranges(size // 31)
    with pytest.raises(Exception, match="split otherwise"):
        df.collect()


def test_written_reviews(spark, tmp_dir):
    src = reviews_view(spark, SF_SMALL)
    out = os.path.join(tmp_dir, "csv")
    write_reviews_csv(src, out)
    back, whole = read_reviews_csv(spark, out, split=True), read_reviews_csv(spark, out)
    assert back.columns == whole.columns and back.exceptAll(whole).count() == whole.exceptAll(back).count() == 0


def test_states_after_lines():
    rng = random.Random(7)
    for _ in range(300):
        n = rng.randint(1, 12)
        open0, open1 = (np.array([rng.random() < 0.5 for _ in range(n)]) for _ in range(2))
        for start in (False, True):
            state, want = start, []
            for a, b in zip(open0, open1):
                state = bool(b if state else a)
                want.append(state)
            assert split_csv._after(open0, open1, start).tolist() == want
