from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera import cli
from tessera.errors import ConstraintError, CycleError, SourceError, StageError
from tessera.functions import encoders as enc
from tessera.functions.plugins import resolve
from tessera.operators import evaluate as ev
from tessera.plans import build as bd
from tessera.plans import index, match
from tessera.sources.store import StorePath
from tests.engine import fixtures as fx


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("index")
    return index.build_index(spark, fx.write_package(d / "p.zip"), str(d / "work")), d


def test_records(spark, built):
    rows = {r.uri: r for r in built[0].read(spark, "records").collect()}
    assert set(rows) == {fx.CHEESE, fx.RIPENING, fx.PASTRY, fx.TASTING}
    made, ripe, tasted = rows[fx.CHEESE], rows[fx.RIPENING], rows[fx.TASTING]
    assert made.alternative_labels == ["curd worker", "fromager"] and made.hidden_labels == ["cheezmaker"]
    assert made.essential_skills == sorted(fx.SKILLS[:3]) and made.optional_skills == [fx.SKILLS[4]] and tasted.essential_skills == []
    # The longer way up is the canonical one.
    assert (ripe.level, ripe.parent_id, ripe.terminal_id, ripe.major) == (5, fx.CHEESE, fx.group("751"), "7")
    assert ripe.path_text == "Crafts > Food crafts > Dairy crafts > cheese maker" and tasted.path_text == "Crafts > Food crafts > Dairy crafts"
    assert tasted.collections == rows[fx.PASTRY].collections == ["research"] and made.collections == []
    assert ripe.green_share == 0.125 and rows[fx.PASTRY].green_share is None
    report = json.loads((built[0].path / "validate.json").read_text())
    assert report["statistics"]["by_major"] == {"7": 4} and report["source"]["occupations"]["rows"] == 5
    assert built[0].read(spark, "labels").count() == 9


def test_steps_one_by_one(spark, tmp_path):
    source, work = fx.write_package(tmp_path / "p.zip"), str(tmp_path / "w")
    states = lambda b: [b.state(s) == "completed" for s in index.STAGES]
    for until, n in (("records", 1), ("validate", 2), ("lexical", 5), ("verify", 6)):
        made = index.build_index(spark, source, work, until=until)
        assert states(made) == [True] * n + [False] * (6 - n)
    assert {cli.STEPS[c][0] for c in ("validate", "embed", "verify")} == {"validate", "lexical", "verify"}


def test_a_stopped_stage_goes_on_with_the_missing_parts(spark, tmp_path):
    made, fail = [], [True]

    def part(i):
        if i == 2 and fail[0]:
            raise RuntimeError("gone")
        made.append(i)
        return spark.range(i * 10, i * 10 + 10)

    b = bd.Build(tmp_path / "b", ("one", "two"), {"one": "f"})
    with pytest.raises(RuntimeError):
        b.sharded(spark, "one", part, 4)
    assert b.state("one") == "failed" and made == [0, 1]
    next((b.path / "one" / "shard-00001-of-00004").glob("part-*")).unlink()  # damage
    fail[0] = False
    rows = bd.Build(b.path, b.stages, {"one": "f"}).sharded(spark, "one", part, 4)
    assert made == [0, 1, 1, 2, 3] and sorted(r.id for r in rows.collect()) == list(range(40)) and rows.columns == ["id"]
    assert b.sharded(spark, "one", part, 4).count() == 40 and len(made) == 5
    other = bd.Build(tmp_path / "c", ("one", "two"), {"one": "f"})
    assert other.sharded(spark, "one", part, 4).count() == 40 and len(made) == 5  # adopted


def test_same_build_is_kept_and_damage_is_made_good(spark, built):
    build, d = built
    before = build.manifest()
    again = index.build_index(spark, str(d / "p.zip"), str(d / "work"))
    assert again.path == build.path and again.manifest() == before
    victim = next((build.path / "lexical").glob("part-*"))
    victim.unlink()
    assert not build.intact(spark, "lexical")
    index.build_index(spark, str(d / "p.zip"), str(d / "work"))
    assert build.intact(spark, "lexical") and build.state("verify") == "completed"


def test_equal_layers_are_adopted(spark, built, monkeypatch):
    from tessera.functions import encoders

    build, d = built
    monkeypatch.setitem(encoders.ENCODERS, "hash8", lambda: encoders.HashEncoder(8))
    other = index.build_index(spark, str(d / "p.zip"), str(d / "work"), {"encoder": "hash8"})
    stages = other.manifest()["stages"]
    assert other.path != build.path and stages["records"]["adopted_from"] == build.path.name and "adopted_from" not in stages["semantic"]


def test_bad_packages(spark, tmp_path):
    t = fx.tables()
    o, skills, up = t["occupations_en.csv"], t["occupationSkillRelations_en.csv"], t["broaderRelationsOccPillar_en.csv"]
    cases = {
        "repeated rows agree": {"occupations_en.csv": [*o, fx.occupation(fx.PASTRY, "another", modifiedDate="2025-01-01")]},
        "status in domain": {"occupations_en.csv": [*o, fx.occupation(fx._uri("occupation", 7), "x", status="odd")]},
        "conceptUri well-formed": {"occupations_en.csv": [*o, fx.occupation("http://x/1", "x")]},
        "skill URI well-formed": {"occupationSkillRelations_en.csv": [*skills, [fx.TASTING, "optional", "", "http://x/skill/1"]]},
        "uri references": {"occupationSkillRelations_en.csv": [*skills, [fx._uri("occupation", 8), "optional", "", fx.SKILLS[0]]]},
        "essential_skills and optional_skills disjoint": {"occupationSkillRelations_en.csv": [*skills, [fx.CHEESE, "optional", "", fx.SKILLS[0]]]},
        "greenShare in": {"greenShareOcc_en.csv": [["conceptUri", "greenShare"], [fx.TASTING, "1.5"]]},
        "research members exist": {"researchOccupationsCollection_en.csv": [["conceptUri"], [fx._uri("occupation", 9)]]},
        "parent exists": {"broaderRelationsOccPillar_en.csv": [*up, [fx.PASTRY, fx.group("99")]]},
    }
    for i, (message, changed) in enumerate(cases.items()):
        with pytest.raises(ConstraintError, match=message.replace("[", r"\[")):
            index.build_index(spark, fx.write_package(tmp_path / f"{i}.zip", changed), str(tmp_path / f"w{i}"), until="validate")
    ring = {"broaderRelationsOccPillar_en.csv": [*up, [fx.CHEESE, fx.RIPENING]]}
    with pytest.raises(CycleError, match=f"{min(fx.CHEESE, fx.RIPENING)}.*{max(fx.CHEESE, fx.RIPENING)}"):
        index.build_index(spark, fx.write_package(tmp_path / "c.zip", ring), str(tmp_path / "wc"), until="records")


def test_later_date_wins(spark, tmp_path):
    o = fx.tables()["occupations_en.csv"]
    repeated = list(o[4])
    repeated[o[0].index("modifiedDate")] = "2025-02-03T00:00:00Z"
    b = index.build_index(spark, fx.write_package(tmp_path / "p.zip", {"occupations_en.csv": [*o, repeated]}), str(tmp_path / "w"), until="records")
    assert str(b.read(spark, "records").where(F.col("uri") == fx.PASTRY).first().modified_at).startswith("2025-02-03")


def test_stage_rules(tmp_path):
    b = bd.Build(tmp_path / "b", ("one", "two", "verify"))
    with pytest.raises(StageError):
        b.step("two", dict, ["one"])
    for s in b.stages:
        b.step(s, dict)
    bd.promote(b, tmp_path / "now")
    assert bd.promoted(tmp_path / "now") == str(b.path)
    b.step("one", dict)
    assert b.state("two") == b.state("verify") == "pending"
    with pytest.raises(StageError):
        bd.promote(b, tmp_path / "now")
    with pytest.raises(ZeroDivisionError):
        b.step("one", lambda: 1 / 0)
    assert b.state("one") == "failed"
    with pytest.raises(StageError):
        bd.check_pointer(tmp_path / "now", "elsewhere")
    a, c = bd.layered([("x", 1), ("y", 2)]), bd.layered([("x", 1), ("y", 3)])
    assert a["x"] == c["x"] and a["y"] != c["y"]


@pytest.fixture(scope="module")
def matched(spark, built, tmp_path_factory):
    d = tmp_path_factory.mktemp("match")
    bd.promote(built[0], d / "now")
    given = fx.write_json(d / "j.json", fx.POSTINGS), fx.write_json(d / "t.json", fx.TAXONOMY)
    settings = {"it_root": "kitchen", "platform": "craft", "shards": 2}
    run = lambda **more: match.match_postings(spark, *given, str(d / "now"), str(d / "m"), settings | more)
    return run(), run, d


def test_postings_and_queries(spark, matched):
    made = matched[0]
    rows = {r.external_id: r for r in made.read(spark, "postings").collect()}
    assert set(rows) == {"P-07", "P-11", "P-23"} and rows["P-07"].job_id == "craft:P-07"
    a, b = rows["P-07"], rows["P-11"]
    assert [(c.key, c.declared_path) for c in a.it_category_paths] == [("k-milk-hard", "Kitchen > Milk > Hard cheese"), ("k-oven", "Kitchen > Oven")]
    assert [c.key for c in a.secondary_category_paths] == ["farm"] and len(a.unresolved_categories) == 1
    c = b.it_category_paths[0]
    assert (c.declared_root, c.canonical_root, c.root_conflict, c.terminal_conflict) == ("kitchen", "shop", True, True) and b.unresolved_categories[0].key == "nowhere"
    assert a.title == "Cheese maker, hard cheese" and a.description == "You press&nbsp;curd and salt wheels"
    assert a.common_info == {"pay": "by hour"} and a.require_summary == ["early shifts"] and a.knowledge == ["curdling"]
    report = json.loads((made.path / "validate.json").read_text())
    assert report["root_conflicts"] == 1 and report["skipped"] == {"queued": 2, "None": 1} and report["unresolved_categories"] == 2 and report["no_description"] == 1
    q = {r.job_id: r for r in made.read(spark, "queries").collect()}["craft:P-07"]
    assert q.label == "Title: Cheese maker, hard cheese\nIT categories: Hard cheese; Oven" and q.lexical == "Cheese maker, hard cheese\nHard cheese\nOven\ncurdling"


def test_matches(spark, built, matched, tmp_path):
    made, run, d = matched
    concepts = {r.id: r.uri for r in built[0].read(spark, "records").collect()}
    rows = made.read(spark, "rerank").collect()
    top = {r.job_id: concepts[r.concept_id] for r in rows if r["rank"] == 1}
    assert top["craft:P-07"] in (fx.CHEESE, fx.RIPENING) and top["craft:P-11"] == fx.PASTRY and top["craft:P-23"] == fx.TASTING
    assert {r.index_build for r in rows} == {built[0].path.name} and all(r.content_hash for r in rows)
    assert run().path == made.path and made.manifest()["stages"]["retrieve"]["path"].endswith("shard-*-of-00002")
    summary = cli.decide(spark, str(made.path), str(tmp_path / "out"), 0.0)
    assert summary["postings"] == 3 and summary["mapped"] == 3 and (tmp_path / "out" / "report.md").exists()
    cyclic = [*fx.TAXONOMY, {"externalId": "u", "name": "x", "parentExternalId": "v"}, {"externalId": "v", "name": "y", "parentExternalId": "u"}]
    with pytest.raises(ConstraintError, match="cycle"):
        match.match_postings(spark, str(d / "j.json"), fx.write_json(tmp_path / "c.json", cyclic), str(d / "now"), str(tmp_path / "m"))


def test_a_chosen_index_needs_no_pointer(spark, built, matched, tmp_path):
    d = matched[2]
    made = match.match_postings(spark, str(d / "j.json"), str(d / "t.json"), None, str(tmp_path / "m"), {"it_root": "kitchen"}, str(built[0].path))
    assert made.state("verify") == "completed"


def shouting(queries, documents):
    return [None if "taster" in d else float(len(d)) for d in documents]


def make_shouting():
    return shouting


def test_a_chosen_reranker(spark, matched, monkeypatch):
    run = matched[1]
    monkeypatch.setitem(ev.RERANKERS, "long", lambda: lambda q, docs: [None if "taster" in d else float(len(d)) for d in docs])
    rows = run(reranker="long", rerank_top=3).read(spark, "rerank").collect()
    for r in rows:
        assert (r.rerank_score is None) == (r.rerank_rank is None) and (r["rank"] <= 3 or r.rerank_score is None)
    with pytest.raises(SourceError, match="no reranker 'odd'"):
        run(reranker="odd")
    assert resolve("reranker", "tests.engine.test_builds:make_shouting", {}) is make_shouting
    with pytest.raises(SourceError, match="can't be loaded"):
        resolve("encoder", "tests.engine.nothing:x", {})
    with pytest.raises(SourceError, match="remote:URL#DIMENSION"):
        enc.encoder_of("remote:http://x")
    assert enc.encoder_of("remote:http://x:1/v#12")().dimension == 12


def test_faulty_matches(spark, built, matched):
    made = matched[0]
    name = built[0].path.name
    rows, concepts = made.read(spark, "postings"), built[0].read(spark, "records")
    good = made.read(spark, "rerank")
    assert match.verify(good, rows, concepts, name)["jobs"] == 3
    one = (F.col("job_id") == "craft:P-11") & (F.col("rank") == 1)
    changes = {
        "ranks from 1": ("rank", F.lit(9).cast("long")),
        "rerank ranks": ("rerank_rank", F.lit(40).cast("long")),
        "as they were matched": ("content_hash", F.lit("0")),
        "of this index": ("index_build", F.lit("other")),
        "finite": ("fused", F.lit(float("nan"))),
        "concept_id references": ("concept_id", F.lit("nobody")),
    }
    for message, (column, value) in changes.items():
        with pytest.raises(ConstraintError, match=message):
            match.verify(good.withColumn(column, F.when(one, value).otherwise(F.col(column))), rows, concepts, name)
    asked = made.read(spark, "queries")
    texts = built[0].read(spark, "lexical").select(F.col("id").alias("concept_id"), F.col("text").alias("document"))
    with pytest.raises(ConstraintError, match="concept_id references"):
        match.rerank_pairs(good, asked, texts.limit(1))
    with pytest.raises(ConstraintError, match="job_id references"):
        match.rerank_pairs(good, asked.where("job_id <> 'craft:P-23'"), texts)


class Session:
    """A model of two dimensions: a token's id and 1."""

    def get_outputs(self):
        return [type("Out", (), {"shape": [None, None, 2]})]

    def run(self, names, given):
        ids = given["input_ids"]
        return [np.stack([ids, np.ones_like(ids)], axis=-1)]


class Tokens:
    def enable_truncation(self, most):
        self.most = most

    def enable_padding(self):
        pass

    def encode_batch(self, texts):
        ids = [[len(w) for w in t.split()][: self.most] for t in texts]
        n = max(map(len, ids))
        return [type("E", (), {"ids": x + [0] * (n - len(x)), "attention_mask": [1] * len(x) + [0] * (n - len(x))}) for x in ids]


def test_a_local_model():
    model = enc.LocalEncoder("", 3, Session(), Tokens())
    v = enc.encode_batched(model, ["aa aaaa", "a a a aaaaaaaaa"])
    assert np.allclose(v, [[3 / 10**0.5, 1 / 10**0.5], [2**-0.5, 2**-0.5]])


def test_command_line_errors(tmp_path, capsys):
    assert cli.main(["promote", "--build-dir", str(tmp_path), "--pointer", str(tmp_path / "p")]) == 1
    assert "not completed" in capsys.readouterr().err


def test_builds_in_a_store(spark, tmp_path):
    root = f"file://{tmp_path}"
    source = fx.write_package(tmp_path / "p.zip")
    made = index.build_index(spark, source, f"{root}/work")
    assert isinstance(made.path, StorePath) and made.state("verify") == "completed" and (made.path / "validate.json").exists()
    bd.promote(made, f"{root}/at/now")
    bd.promote(made, f"{root}/at/now")  # replaced
    assert bd.promoted(f"{root}/at/now") == str(made.path) and [p.name for p in StorePath(f"{root}/at").glob("*")] == ["now"]
    assert index.build_index(spark, source, f"{root}/work").manifest() == made.manifest()
    other = index.build_index(spark, source, f"{root}/work", {"encoder": "tests.engine.test_builds:make_small"}, until="lexical")
    assert other.manifest()["stages"]["records"]["adopted_from"] == made.path.name
    with pytest.raises(StageError):
        bd.promoted(f"{root}/at/nothing")


def make_small():
    return enc.HashEncoder(8)
