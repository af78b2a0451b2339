import pytest
from pyspark.sql import functions as F

from cellweave.operators import profile, shape
from cellweave.plans import ingest
from cellweave.plans import rules as R


def header_of(grid, rules, rows):
    return shape.find_headers(grid({"s": rows}), rules).first().header_row


def test_header_by_keywords(grid):
    rows = [["Titre", None], [None, None], ["Date", "Site"], ["Date", "Motif"], ["x", "y"]]
    assert header_of(grid, R.FQT, rows) == 2


def test_header_needs_two_hits(grid):
    assert header_of(grid, R.FQT, [["a", "b", "c"], ["Date", "1", "2"]]) == 0
    assert header_of(grid, R.CATCLIENTS, [["a", "b"], ["x", "Libellé"]]) == 1
    assert header_of(grid, R.CATCLIENTS, [["a", "b"], ["x", "y"]]) == 0


def test_header_by_density_and_ties(grid):
    # Missing cells count like text; numbers count less; blanks do not count.
    rows = [["1", "2", "3"], ["Alpha", "Beta", "Gamma"], ["Un", "Deux", "Trois"], [" ", "1", None]]
    assert header_of(grid, R.RPA, rows) == 1
    assert header_of(grid, R.PAAE, rows) == 2


def test_header_beyond_the_scan_is_not_found(grid):
    rows = [["1", "2"]] * 25 + [["Date", "Site"]]
    assert header_of(grid, R.FQT, rows) == 0
    # Blank rows do not count towards the scan.
    assert header_of(grid, R.FQT, [[None, None]] * 40 + [["Date", "Site"]]) == 40


def test_header_rank_is_limited_before_the_shuffle(grid):
    rows = shape.drop_blank_rows(grid({"s": [["a"]] * 50})).select("path", "sheet_idx", "row_idx")
    from pyspark.sql import Window

    ranked = rows.withColumn("p", F.row_number().over(Window.partitionBy("path", "sheet_idx").orderBy("row_idx")))
    plan = ranked.filter("p <= 25")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_unique_names_per_rules(grid):
    rows = [["Date", "Site", "Site", "Site", None], ["1", None, "2", "3", "x"], ["1", None, "2", "4", "y"]]
    for rules, names in ((R.FQT, ["date", "site_2", "site_3", "col"]), (R.RPA, ["date", "site", "site_2", "col"])):
        got = ingest.decide_sheets(grid({"s": rows}), rules).orderBy("col_idx").collect()
        assert [r.name for r in got] == names


@pytest.mark.parametrize("rules, kept", [(R.SPA, [0, 4]), (R.FQT, [0, 2, 4]), (R.CATCLIENTS, [0])])
def test_blank_column_rules(grid, rules, kept):
    """Columns: text, all blank, blanks and nulls, all null, the text nan."""
    rows = [["Date", "Site", "Libelle", "Categorie", "Top"], ["a", " ", " ", None, " nan"], ["b", " ", None, None, " nan"]]
    sheet = grid({"s": rows})
    headers = shape.find_headers(sheet, rules)
    stats = profile.profile_body(shape.body_rows(sheet, headers), headers, rules)
    assert sorted(r.col_idx for r in stats.filter(shape.column_survives(rules)).collect()) == kept


def test_ragged_rows_count_as_null(grid):
    rows = [["Date", "Site", "Motif"], ["a"], ["b"], ["c", "x", "y"]]
    got = {r.name: (r.n, r.n_value) for r in ingest.decide_sheets(grid({"s": rows}), R.FQT).collect()}
    assert got == {"date": (3, 3), "site": (3, 1), "motif": (3, 1)}


def test_table_names(spark):
    df = spark.createDataFrame([("fichier", "Été 1", 1), ("fichier", "Été 1", 2), ("f" * 70, "x", 1)], "b string, s string, n int")
    got = [r[0] for r in df.select(shape.table_name(F.col("b"), F.col("s"), F.col("n"))).collect()]
    assert got == ["fichier", "fichier__ete_1", "f" * 63]


def test_pivot_round_trip(grid):
    rows = grid({"s": [["a", None], ["b", "c"]]})
    again = shape.cells_to_rows(shape.rows_to_cells(rows), 2)
    assert sorted(map(str, again.collect())) == sorted(map(str, rows.collect()))


def test_client_categories(grid):
    sheets = {
        "A": [["Libellé", "Top Custo HFM", "Catégorie"], ["x", "t1", None], ["y\xa0", "t2", "c2"], [None, "t3", None]],
        "B": [["note", None], ["CATEGORY", "libelle"], ["c1", "x"], [" ", "y"], ["c9", None]],
        "C": [["rien", "ici"], ["1", "2"]],
    }
    got = {r.libelle: (r.top_custo_hfm, r.categorie) for r in ingest.client_categories(grid(sheets)).collect()}
    assert got == {"x": (None, "c1"), "y": ("t2", "c2"), None: (None, "c9")}
    with pytest.raises(ValueError):
        ingest.client_categories(grid({"s": [["Top", "Categorie"], ["a", "b"]]}))


@pytest.mark.parametrize(
    "rows, types",
    [
        ([["1", "a", "30"], ["2", "b", "45,0"]], [("code_condition", "bigint"), ("libelle", "string"), ("delai_source", "bigint")]),
        ([["1", "a", "30,5"], ["x", "b", "2"]], [("code_condition", "string"), ("libelle", "string"), ("delai_source", "string")]),
        ([["1", "a", "texte"]], [("code_condition", "bigint"), ("libelle", "string"), ("delai_source", "bigint")]),
        ([["1", None, "a"]], [("code_condition", "bigint"), ("libelle", "string")]),
        ([["1", "a", "2", "b", "c"]], [("code_condition", "bigint"), ("libelle", "string"), ("delai_source", "bigint")]),
    ],
)
def test_payment_terms(grid, rows, types):
    assert ingest.payment_terms(grid({"s": rows, "t": [["ignored"] * 3]})).dtypes == types


def test_payment_terms_need_two_columns(grid):
    with pytest.raises(ValueError):
        ingest.payment_terms(grid({"s": [["a"], ["b"]]}))


def test_cells_are_dealt_by_row_before_they_are_sorted(grid):
    rows = grid({"a": [["x", None], ["y", "z"]], "b": [[None, "w"]]})
    wide = shape.pivot_cells(shape.rows_to_cells(rows), 2)
    assert sorted(tuple(r)[2:] for r in wide.collect()) == [(0, 0, "x", None), (0, 1, "y", "z"), (1, 0, None, "w")]
    plan = wide._jdf.queryExecution().sparkPlan().toString()
    prepared = wide._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert "Aggregate" in plan and "Aggregate" not in prepared.split("Exchange", 1)[1]
