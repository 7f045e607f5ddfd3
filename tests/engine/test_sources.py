from __future__ import annotations

import pytest

from tessera.errors import SourceError
from tessera.sources import package as pk
from tests.engine import fixtures as fx


def test_members_by_base_name():
    names = ["a/b/X.csv", "c\\Y.csv"]
    assert pk.find_member(names, "x.CSV") == "a/b/X.csv" and pk.find_member(names, "y.csv") == "c\\Y.csv"
    assert pk.find_member(names, "z.csv", required=False) is None
    with pytest.raises(SourceError):
        pk.find_member(names, "z.csv")
    with pytest.raises(SourceError):
        pk.find_member([*names, "x.csv"], "x.csv")


def test_strict_csv():
    header, rows = pk.parse_csv("t", b'\xef\xbb\xbf a ,b\n1\n"x\ny",2\n , \n')
    assert header == ["a", "b"] and rows == [["1", ""], ["x\ny", "2"]]
    for bad in (b"a,a\n", b"a,\n", b"", b"a\n1,2\n", b"a\n\xff\n", b'a\n"x"y\n'):
        with pytest.raises(SourceError):
            pk.parse_csv("t", bad)
    with pytest.raises(SourceError):
        pk.require_columns("t", ["a"], ["a", "b"])


def test_package(spark, tmp_path):
    p = pk.load_package(spark, fx.write_package(tmp_path / "p.zip"))
    report = pk.profile(p)
    assert report["occupations"]["rows"] == 5 and "inScheme" in report["occupations"]["extra"]
    assert {r.conceptUri for r in pk.collection_uris(p.tables["research"]).collect()} == {fx.TASTING, fx.PASTRY}
    assert p.tables["occupations"].where("_row = 1").first().description.endswith('"raw" cheese,\nfrom curdling to pressing.')
    fewer = pk.load_package(spark, fx.write_package(tmp_path / "f.zip", {"greenShareOcc_en.csv": None}))
    assert "shares" not in fewer.tables
    with pytest.raises(SourceError):
        pk.load_package(spark, fx.write_package(tmp_path / "g.zip", {"ISCOGroups_en.csv": None}))
    pk.split_package(str(tmp_path / "p.zip"), str(tmp_path / "s.zip"), ["ISCOGroups_en.csv"])
    with pytest.raises(SourceError):
        pk.load_package(spark, str(tmp_path / "s.zip"))


def test_json_and_csv_files(spark, tmp_path):
    rows = pk.read_postings(spark, fx.write_json(tmp_path / "j.json", fx.POSTINGS))
    assert rows.count() == 6 and rows.schema == pk.POSTING
    assert pk.read_taxonomy(spark, fx.write_json(tmp_path / "t.json", fx.TAXONOMY)).count() == 7
    with pytest.raises(SourceError):
        pk.read_taxonomy(spark, fx.write_json(tmp_path / "d.json", fx.TAXONOMY + fx.TAXONOMY[:1]))
    (tmp_path / "c.csv").write_text('a,b\n1,2\n"x\ny",3\n4\n5,6,7\n')
    got = {r.a: r for r in pk.read_csv(spark, str(tmp_path / "c.csv"), ["a", "b"]).collect()}
    assert got["x\ny"].b == "3" and got["1"]._corrupt_record is None and got["5"]._corrupt_record is not None


def test_settings_and_reports(tmp_path):
    (tmp_path / "s.toml").write_text("a = 2\n")
    assert pk.load_settings(str(tmp_path / "s.toml"), {"a": 1, "b": "x"}, {"TESSERA_B": "[1]"}) == {"a": 2, "b": [1]}
    (tmp_path / "s.json").write_text('{"c": 1}')
    with pytest.raises(SourceError):
        pk.load_settings(str(tmp_path / "s.json"), {"a": 1}, {})
    pk.write_json(tmp_path / "x" / "r.json", {"b": 1, "a": None})
    assert (tmp_path / "x" / "r.json").read_text().index('"a"') < (tmp_path / "x" / "r.json").read_text().index('"b"')
    assert pk.markdown_table(["a|b"], [["x\ny"], [None]]).splitlines()[0] == "| a\\|b |"
