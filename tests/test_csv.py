from __future__ import annotations

from decimal import Decimal

import pytest
from conftest import ts

from bazaarlake.config import WarehouseConfig
from bazaarlake.plans.pipeline import load_bronze
from bazaarlake.sources.audit import BATCH, LoadError
from bazaarlake.sources.csv_files import BAD_LINE, SOURCES, accepted, read_raw, rejected
from bazaarlake.sources.tables import read_table, replace_table


def write(path, text):
    path.write_bytes(text.encode("utf-8"))
    return str(path)


def test_raw_quotes_stay_and_every_comma_splits(spark, tmp_path):
    path = write(
        tmp_path / "c.csv",
        'h1,h2,h3,h4,h5\n"c1","u1","01001","são paulo","SP"\n"c2",u2,,"x, y",SP\n',
    )
    landed = read_raw(spark, SOURCES["customers"], path, raw_quotes=True)
    good = accepted(landed).collect()
    assert [tuple(r) for r in good] == [('"c1"', '"u1"', '"01001"', '"são paulo"', '"SP"')]
    replace_table(landed, str(tmp_path / "landed"))
    bad = rejected(read_table(spark, str(tmp_path / "landed"), landed.schema), "customers")
    assert [tuple(r) for r in bad.collect()] == [("customers", '"c2",u2,,"x, y",SP')]


def test_proper_quotes_keep_commas_and_empty_is_null(spark, tmp_path):
    path = write(
        tmp_path / "c.csv", 'h1,h2,h3,h4,h5\n"c1","u1","01001","x, ""y""","SP"\nc2,u2,,city,SP\n'
    )
    rows = accepted(read_raw(spark, SOURCES["customers"], path)).orderBy("customer_id").collect()
    assert rows[0]["customer_city"] == 'x, "y"'
    assert rows[1]["customer_zip_code_prefix"] is None


def test_typed_fields_and_bad_values(spark, tmp_path):
    path = write(
        tmp_path / "i.csv",
        "h1,h2,h3,h4,h5,h6,h7\n"
        "o1,1,p1,s1,2018-01-02 03:04:05,10.50,\n"
        "o2,one,p1,s1,2018-01-02 03:04:05,10.50,1.00\n"
        "o3,1,p1\n",
    )
    landed = read_raw(spark, SOURCES["order_items"], path)
    good = accepted(landed).collect()
    assert [tuple(r) for r in good] == [
        ("o1", 1, "p1", "s1", ts("2018-01-02 03:04:05"), Decimal("10.50"), None)
    ]
    assert [r["order_id"] for r in landed.collect() if r["_bad_line"]] == ["o2", "o3"]


def test_crlf_lookup(spark, tmp_path):
    path = write(tmp_path / "t.csv", 'a,b\r\n"x","y"\r\nbeleza,health\r\n')
    rows = accepted(read_raw(spark, SOURCES["category_translation"], path, raw_quotes=True))
    assert sorted(tuple(r) for r in rows.collect()) == [('"x"', '"y"'), ("beleza", "health")]


REVIEW_HEADER = "review_id,order_id,score,title,message,created,answered"


def review(n, message):
    quoted = '"' + message.replace('"', '""') + '"' if message is not None else ""
    return f'"r{n}","o{n}",{n % 5 + 1},"",{quoted},2018-01-01 00:00:00,2018-01-02 00:00:00'


def test_review_text_with_comma_quote_and_line_breaks(spark, conf, tmp_path):
    messages = ["plain", 'said "ok", fine', "two\r\nlines", "a\nb", '"\r\n"\r\n,', "x\r\n\r\ny", None]
    body = "\r\n".join([REVIEW_HEADER, *(review(n, m) for n, m in enumerate(messages))])
    path = write(tmp_path / "r.csv", body + "\r\n")
    for split in ("128m", "64"):
        conf(files__maxPartitionBytes=split)
        rows = accepted(read_raw(spark, SOURCES["order_reviews"], path)).collect()
        got = {r["review_id"]: r["review_comment_message"] for r in rows}
        assert got == {f"r{n}": m for n, m in enumerate(messages)}
        assert {r["review_comment_title"] for r in rows} == {None}


def test_small_and_large_review_files_together(spark, conf, tmp_path):
    folder = tmp_path / "reviews"
    folder.mkdir()
    for k, size in enumerate((1, 200)):
        lines = [review(n, f"{k}\r\n{n}") for n in range(size)]
        write(folder / f"{k}.csv", "\r\n".join([REVIEW_HEADER, *lines]) + "\r\n")
    conf(files__maxPartitionBytes="1024")
    rows = accepted(read_raw(spark, SOURCES["order_reviews"], str(folder))).collect()
    assert len(rows) == 201
    assert sorted(r["review_comment_message"].split("\r\n")[0] for r in rows) == ["0"] + ["1"] * 200


FILES = {
    "a quote in an unquoted field": (
        [f'r{n},o{n},1,t,{"6"}" screen,2018-01-01 00:00:00,2018-01-02 00:00:00' if n == 500
         else review(n, f"{n}\r\nfine") for n in range(3000)], 3000, 0),
    "a quote that is never closed": ([*(review(n, "x") for n in range(12)), 'r12,o12,1,"never closed'], 12, 1),
    "many reviews and a stray quote": (
        [f'r{n},o{n},1,t,{"6" + chr(34) if n == 70 else "m"},2018-01-01 00:00:00,2018-01-02 00:00:00'
         for n in range(20000)], 20000, 0),
}


@pytest.mark.parametrize("raw_quotes", [False, True])
@pytest.mark.parametrize("name", FILES)
def test_reviews_do_not_depend_on_the_split_size(spark, conf, tmp_path, name, raw_quotes):
    lines, good, bad = FILES[name]
    empty_sources(tmp_path / "files")
    write(tmp_path / "files" / "order_reviews.csv", "\r\n".join([REVIEW_HEADER, *lines]) + "\r\n")
    seen = set()
    for split in ("128m", "64k", "100"):
        conf(files__maxPartitionBytes=split, files__openCostInBytes="1")
        path = str(tmp_path / "files" / "order_reviews.csv")
        rows = read_raw(spark, SOURCES["order_reviews"], path, raw_quotes).collect()
        rejects = sum(row[BAD_LINE] is not None for row in rows)
        seen.add((len(rows) - rejects, rejects, hash(tuple(sorted(map(repr, rows))))))
    assert len(seen) == 1 and next(iter(seen))[:2] == (good, bad)


def empty_sources(folder):
    folder.mkdir()
    for name, source in SOURCES.items():
        header = ",".join(source.schema.names)
        write(folder / f"{name}.csv", header + source.line_end)


def payments(tmp_path, bad):
    source = tmp_path / "files" / "order_payments.csv"
    write(source, "a,b,c,d,e\no1,1,boleto,1,2.50\n" + "o2,1,boleto,1,n/a\n" * bad)


def loaded_payments(spark, config):
    return accepted(
        read_table(
            spark,
            config.table_path("bronze", "order_payments"),
            SOURCES["order_payments"].landing_schema,
        )
    )


def test_load_tolerates_few_bad_lines_and_keeps_the_table_on_many(spark, tmp_path):
    empty_sources(tmp_path / "files")
    payments(tmp_path, 10)
    config = WarehouseConfig(str(tmp_path / "files"), str(tmp_path / "wh"))
    audit = {load.table_name: load for load in load_bronze(spark, config)}
    load = audit["order_payments"]
    assert (load.rows_written, load.rows_rejected, load.status) == (1, 10, "loaded")
    assert load.seconds > 0
    total = audit[BATCH]
    assert (total.rows_written, total.rows_rejected, total.status) == (1, 10, "loaded")
    assert total.seconds >= load.seconds

    payments(tmp_path, 11)
    with pytest.raises(LoadError) as error:
        load_bronze(spark, config)
    failed = {load.table_name: load for load in error.value.audit}
    load = failed["order_payments"]
    assert (load.rows_written, load.rows_rejected, load.status) == (0, 11, "failed")
    assert load.seconds > 0 and failed[BATCH].status == "failed"
    assert {x.status for x in failed.values()} == {"failed", "loaded"}
    # The last good load is still there, and nothing else.
    assert loaded_payments(spark, config).count() == 1
    assert len(list((tmp_path / "wh" / "bronze").iterdir())) == len(SOURCES)


def test_share_of_bad_lines_may_be_tolerated(spark, tmp_path):
    empty_sources(tmp_path / "files")
    payments(tmp_path, 30)
    paths = (str(tmp_path / "files"), str(tmp_path / "wh"))
    load_bronze(spark, WarehouseConfig(*paths, max_error_share=0.97))
    with pytest.raises(LoadError):
        load_bronze(spark, WarehouseConfig(*paths, max_error_share=0.96))


def test_rejects_of_a_record_count_its_lines(spark, tmp_path):
    lines = [REVIEW_HEADER, review(1, "good"), 'r2,o2,1,"never closed', *["more"] * 20]
    empty_sources(tmp_path / "files")
    write(tmp_path / "files" / "order_reviews.csv", "\r\n".join(lines) + "\r\n")
    config = WarehouseConfig(str(tmp_path / "files"), str(tmp_path / "wh"))
    with pytest.raises(LoadError, match="21 bad lines"):
        load_bronze(spark, config)


def test_missing_file_raises(spark, tmp_path):
    empty_sources(tmp_path / "files")
    config = WarehouseConfig(
        str(tmp_path / "files"), str(tmp_path / "wh"), files={"orders": "nothing.csv"}
    )
    with pytest.raises(LoadError):
        load_bronze(spark, config)
