"""The pipeline's landed files: many bounded ones, each a whole file of the contract."""

import glob

from conftest import SF, rows
from strata.plans.pipeline import AIRLINE_COLUMNS
from strata.plans.q_stream import airline_lines, write_airline_files
from strata.sources.csv import read_raw


def test_airline_files_are_bounded_and_each_has_its_header(spark, tmp_path):
    write_airline_files(spark, SF, str(tmp_path / "few"), 1)
    write_airline_files(spark, SF, str(tmp_path / "many"), 1, lines_a_file=300)
    few, many = (glob.glob(f"{tmp_path}/{x}/**/part-*", recursive=True) for x in ("few", "many"))
    n = airline_lines(spark, SF, 1).count()
    assert len(few) <= 5 and len(many) >= n // 600
    for f in many:
        lines = open(f).read().splitlines()
        assert lines[0] == ",".join(AIRLINE_COLUMNS) and lines.count(lines[0]) == 1 and len(lines) < 900
        keys = [int(x.split("-")[0]) for x in lines[1:]]
        assert keys == sorted(keys)
    got = [read_raw(spark, str(tmp_path / x), AIRLINE_COLUMNS, with_file=False) for x in ("few", "many")]
    few, many = rows(got[0]), rows(got[1])
    assert len(few) == n and few == many and all(r[-1] is None for r in many)
