import pytest
from conftest import SITE, document, tag

from kilnstream.operators import assets, cells, messages

ASSETS = [(SITE, "Machine001", "Y"), (SITE, "Machine002", "Y"), (SITE, "Machine003", "N")]


def accepted(rows):
    return messages.accepted(messages.parse_machine_messages(rows))


def cells_of(masters, rows, **options):
    pairs = cells.document_tags(accepted(rows), masters.tags)
    return {
        (r["offset"], r["tag_id"]): r["cell"]
        for r in cells.typed_cells(pairs, **options).collect()
    }


def test_cells_by_value_type(masters_of, texts):
    members = {
        "a": "9", "b": "9.0", "c": '""', "d": '"x"', "e": "null",
        "f": '{"$date": "2024-01-02T03:04:05Z"}', "g": '{"$date": 1704164645000}',
        "h": "[1]", "i": "-0.0", "j": "1e10", "k": "true",
        "l": '{"$date": {"$numberLong": "1704164645000"}}', "m": '{"$numberDouble": "2.5"}',
    }
    tags = [tag("Machine001", f"T{key}", key, f"c{key}") for key in members]
    tags += [tag("Machine001", "Tcs", "c", "cs", code="D02"),
             tag("Machine001", "Tcu", "c", "cu", code="D99"),
             tag("Machine001", "Tz", "z", "cz")]
    masters = masters_of(ASSETS, tags)
    body = ", ".join(f'"{key}": {value}' for key, value in members.items())
    rows = texts(document(body))
    found = {key[1][1:]: cell for key, cell in cells_of(masters, rows).items()}
    assert found == {
        "a": None, "b": "9.0", "c": "0.0", "d": "x", "e": None, "f": "2024-01-02 03:04:05",
        "g": "2024-01-02 03:04:05", "h": None, "i": "0.0", "j": "1.0E10", "k": None,
        "l": "2024-01-02 03:04:05", "m": "2.5", "cs": "", "cu": "", "z": None,
    }
    assert cells_of(masters, rows, widen_ints=True)[(0, "Ta")] == "9.0"
    pairs = cells.document_tags(accepted(rows), masters.tags)
    issues = [(r["tag_id"], r["issue"]) for r in cells.cell_issues(pairs).collect()]
    assert issues == [("Tz", cells.KEY_MISSING)]


def test_only_modelled_assets_of_the_site_count(masters_of, texts):
    tags = [tag(f"Machine00{i}", "T1", "7", "c7") for i in range(1, 6)]
    tags += [tag("Machine001", "T1", "7", "c7", site="S2")]
    masters = masters_of(
        [*ASSETS, (SITE, "Machine001", "Y"), ("S2", "Machine004", "Y"),
         (SITE, "Machine005", None), (SITE, "Machine006", "y")],
        tags,
    )
    rows = texts(*[document('"7": 1.0', lot=f"LOT__00{i}_1") for i in range(1, 7)])
    docs = accepted(rows)
    assert [r["offset"] for r in assets.modelled(docs, masters).orderBy("offset").collect()] == [
        0, 1]
    assert sorted(r["offset"] for r in assets.unmodelled(docs, masters).collect()) == [2, 3, 4, 5]
    assert sorted(cells_of(masters, rows)) == [(0, "T1"), (1, "T1")]


def test_wide_rows_in_both_forms(masters_of, texts):
    masters = masters_of(ASSETS, [
        tag("Machine001", "T1", "7", "c7"), tag("Machine001", "T2", "8", "odd `name'"),
        tag("Machine002", "T3", "9", "c7"), tag("Machine002", "T4", "7", "c9", code="D02"),
        tag("Machine003", "T5", "7", "c7"),
    ])
    rows = texts(
        document('"7": 1.5, "8": "x"'),
        document('"7": 2.5, "9": 3.5', lot="LOT__002_1"),
        document('"7": 4.5', lot="LOT__003_1"),
        document('"7": 5.5', lot="LOT__009_1"),
    )
    columns = cells.wide_columns(masters.tags.frame)
    assert columns == ["c7", "odd `name'", "c9"]
    direct = cells.wide_rows(accepted(rows), masters)
    assert direct.columns == ["topic", "partition", "offset", "asset_id", *columns]
    expected = {
        ("t", 0, 0, "Machine001", "1.5", "x", None),
        ("t", 0, 1, "Machine002", "3.5", None, "2.5"),
    }
    assert {tuple(r) for r in direct.collect()} == expected
    long_form = cells.typed_cells(cells.document_tags(accepted(rows), masters.tags))
    pivoted = cells.wide_rows_by_pivot(long_form, masters.tags.frame, columns)
    assert {tuple(r) for r in pivoted.collect()} == expected


@pytest.mark.parametrize("n", [1, 2, 32, 33, 200])
def test_any_number_of_columns(masters_of, texts, n):
    masters = masters_of(ASSETS, [
        tag("Machine001", f"T{i:03d}", f"k{i}", f"c{i}") for i in range(n)
    ])
    body = ", ".join(f'"k{i}": {i}.5' for i in range(0, n, 2))
    row = cells.wide_rows(accepted(texts(document(body))), masters).first().asDict()
    assert [row[f"c{i}"] for i in range(n)] == [
        None if i % 2 else f"{i}.5" for i in range(n)
    ]


def test_typed_wide_rows(masters_of, texts):
    masters = masters_of(ASSETS, [
        tag("Machine001", "T1", "7", "num"), tag("Machine001", "T2", "8", "word", code="D02"),
        tag("Machine001", "T3", "7", "mixed"), tag("Machine002", "T4", "7", "mixed", code="D02"),
    ])
    wide = cells.wide_rows(accepted(texts(document('"7": 1.5, "8": "x"'))), masters, typed=True)
    assert dict(wide.dtypes)["num"] == "double"
    assert dict(wide.dtypes)["mixed"] == "string"
    assert wide.select("num", "word", "mixed").first().asDict() == {
        "num": 1.5, "word": "x", "mixed": "1.5"
    }


def test_first_tag_owns_a_shared_alias(masters_of, texts):
    masters = masters_of(ASSETS, [
        tag("Machine001", "T2", "8", "c"), tag("Machine001", "T1", "7", "c"),
        tag("Machine001", "T3", "7", None), tag("Machine001", "T4", None, "d"),
        tag("Machine001", "T5", "7", "e", limits=["x", "1", "NaN"]),
    ])
    row = cells.wide_rows(accepted(texts(document('"7": 1.5, "8": 2.5'))), masters).first()
    assert (row["c"], row["d"], row["e"]) == ("1.5", None, "1.5")
    issues = {(r["asset_id"], r["tag_id"], r["issue"])
              for r in assets.master_issues(masters).collect()}
    assert issues == {
        ("Machine001", "T2", assets.ALIAS_TAKEN), ("Machine001", "T3", assets.ALIAS_MISSING),
        ("Machine001", "T4", assets.BAD_KEY), ("Machine001", "T5", assets.BAD_LIMIT),
        ("Machine002", None, assets.NO_TAGS),
    }


def test_code_names(spark):
    from conftest import code_frame, tag_frame

    tags = tag_frame(spark, [tag("A", "T1", "7", "x"), tag("A", "T2", "7", "y", code="D99")])
    named = assets.with_code_names(tags, code_frame(spark))
    assert {r["tag_id"]: r["data_type_nm"] for r in named.collect()} == {
        "T1": "DOUBLE", "T2": None
    }
    scanned = assets.scan_tags(tags, code_frame(spark), SITE, limits=True)
    assert len(scanned.columns) == 13
