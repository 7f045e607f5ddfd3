"""A package of food crafts, a category forest and postings, made for these tests.

File and column names are the source's contract (fixed values)."""

from __future__ import annotations

import csv
import io
import json
import zipfile
from pathlib import Path

HOST = "https://kb.invalid/v4"


def _uri(kind: str, n: int) -> str:
    return f"{HOST}/{kind}/{n * 7919:08x}-{n:04x}-4abc-9def-{n * 104729:012x}"


CHEESE, RIPENING, PASTRY, TASTING, ICE = (_uri("occupation", n) for n in (21, 34, 55, 89, 144))
SKILLS = [_uri("skill", n) for n in range(300, 305)]
#: Two trees of groups: crafts (four levels) and inspection (two).
GROUPS = {"7": "Crafts", "75": "Food crafts", "751": "Dairy crafts", "752": "Baking crafts", "3": "Inspection", "33": "Food inspection"}


def group(code: str) -> str:
    return f"{HOST}/isco/C{code}"


_OCCUPATION = ("conceptType", "conceptUri", "iscoGroup", "preferredLabel", "altLabels", "hiddenLabels", "status", "modifiedDate", "regulatedProfessionNote", "scopeNote", "definition", "inScheme", "description", "code", "naceCode")


def occupation(uri, label, **given):
    own = {"conceptType": "Occupation", "conceptUri": uri, "preferredLabel": label, "status": "released", "modifiedDate": "2023-09-14T06:30:00Z"} | given
    return [own.get(c, "") for c in _OCCUPATION]


def tables():
    above = [("75", "7"), ("751", "75"), ("752", "75"), ("33", "3")]
    # Ripening hangs under cheese making and, one level up, under food crafts; tasting under both trees.
    placed = [(CHEESE, group("751")), (RIPENING, CHEESE), (RIPENING, group("75")), (PASTRY, group("752")), (TASTING, group("33")), (TASTING, group("751")), (ICE, group("75"))]
    return {
        "occupations_en.csv": [
            list(_OCCUPATION),
            occupation(ICE, "ice harvester", status="obsolete", iscoGroup="75"),
            occupation(CHEESE, "cheese maker", altLabels="curd worker\nCHEESE  Maker\nfromager\nCurd worker", hiddenLabels="Fromager\ncheezmaker", iscoGroup="751", code="751.4", description='Turns milk into "raw" cheese,\nfrom curdling to pressing.'),
            occupation(RIPENING, "cheese ripener", altLabels="affineur", iscoGroup="751", description="Turns and brushes wheels in a cellar."),
            occupation(PASTRY, "pastry baker", iscoGroup="752", altLabels="viennoiserie baker\nconfectioner", scopeNote="Excludes bread."),
            occupation(TASTING, "dairy taster", iscoGroup="33", description="Judges smell and taste of dairy goods."),
        ],
        "ISCOGroups_en.csv": [["conceptUri", "code", "preferredLabel"], *[[group(c), c, label] for c, label in GROUPS.items()]],
        "broaderRelationsOccPillar_en.csv": [["conceptUri", "broaderUri"], *[[group(a), group(b)] for a, b in above], *map(list, placed)],
        "occupationSkillRelations_en.csv": [
            ["occupationUri", "relationType", "skillType", "skillUri"],
            *[[CHEESE, "essential", "knowledge", s] for s in (SKILLS[2], SKILLS[0], SKILLS[1])],
            [CHEESE, "OPTIONAL", "", SKILLS[4]],
            [PASTRY, "essential", "skill/competence", SKILLS[3]],
        ],
        "researchOccupationsCollection_en.csv": [["conceptUri"], [TASTING], ["  "], [PASTRY], [TASTING]],
        "greenShareOcc_en.csv": [["conceptUri", "greenShare"], [RIPENING, "0.125"], [PASTRY, ""]],
    }


def write_package(path: Path, changed=None) -> str:
    with zipfile.ZipFile(path, "w") as z:
        for name, rows in (tables() | (changed or {})).items():
            if rows is None:
                continue
            text = io.StringIO()
            csv.writer(text).writerows(rows)
            z.writestr(f"export 4/{name}", b"\xef\xbb\xbf" + text.getvalue().encode())
    return str(path)


#: A forest of three roots; the tests take "kitchen" for the wanted one.
TAXONOMY = [
    {"externalId": i, "name": name, "parentExternalId": up}
    for i, name, up in (("kitchen", "Kitchen", None), ("k-milk", "Milk", "kitchen"), ("k-milk-hard", "Hard cheese", "k-milk"), ("k-oven", "Oven", "kitchen"), ("shop", "Shop", ""), ("s-till", "Till", "shop"), ("farm", "Farm", None))
]


def category(key, name, *levels):
    return {"key": key, "name": name, **{f"level{i + 1}Id": v for i, v in enumerate(levels)}}


def posting(key, title, categories, status="completed", **more):
    return {"externalId": key, "status": status, "title": title, "updatedAt": {"$date": "2023-11-02T18:45:00"}, "categories": categories, **more}


POSTINGS = [
    posting(
        "P-07", "Cheese maker, <b>hard cheese</b>", [category("k-milk-hard", "Hard cheese", "kitchen", "k-milk", "k-milk-hard"), category("", "loose"), category("farm", "Farm", "farm"), category("k-oven", "Oven", "kitchen", "k-oven")],
        description="<p>You press&nbsp;curd\n and salt wheels</p>", knowledge=[{"id": "9", "title": " curdling "}, {"id": "8", "title": None}], requireSummary=["early  shifts", "", None], requireCandidate="strong arms", commonInfo={"pay": " by  hour", "bonus": None},
    ),
    # Its key lies under the shop, its declared levels under the kitchen.
    posting("P-11", "Pastry baker", [category("s-till", "Till", "kitchen", "k-oven", "k-oven"), category("nowhere", "gone", "shop")], description="Puff pastry"),
    posting("P-23", "Taster of dairy goods", []),
    posting("P-31", "Another", [], status="queued"),
    posting("P-32", "One more", [], status="queued"),
    posting("P-33", "Last", [], status=None),
]


def write_json(path: Path, value) -> str:
    path.write_text(json.dumps(value))
    return str(path)
