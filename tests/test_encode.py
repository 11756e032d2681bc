import pytest
from conftest import rows

from demandloom.operators import encode
from demandloom.operators.trees import fit_tree, load_model, save_model, score
from demandloom.settings import TreeSpec

SCHEMA = "grade string, port string, litres int, price double"
DATA = [
    ("heavy", "Turku", 7, 0.5),
    ("light", "Bergen", 3, 2.25),
    ("heavy", "Ghent", 11, 4.0),
    ("medium", "Turku", 2, 8.5),
    ("light", "Turku", 5, 1.75),
]
COLUMNS = ["grade", "port"]


def test_wide_names_and_row_count(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    vocabulary = encode.fit_vocabulary(df, COLUMNS)
    wide = encode.one_hot_wide(df, vocabulary)
    assert wide.count() == 5
    assert wide.columns[4:] == encode.one_hot_names(vocabulary) == [
        "grade_heavy",
        "grade_light",
        "grade_medium",
        "port_Bergen",
        "port_Ghent",
        "port_Turku",
    ]
    flags = [r[4:] for r in rows(wide, *wide.columns)]
    assert all(sum(f[:3]) == 1 and sum(f[3:]) == 1 for f in flags)


@pytest.mark.parametrize(
    "call",
    [
        lambda df: encode.fit_vocabulary(df, ["no_such"]),
        lambda df: encode.category_vocab(df, ["no_such"]),
        lambda df: encode.one_hot_wide(df, {"no_such": ["a"]}),
        lambda df: encode.fit_encoder(df, {"no_such": ["a"]}, []),
    ],
)
def test_unknown_column(spark, call):
    with pytest.raises(KeyError, match="no_such"):
        call(spark.createDataFrame(DATA, SCHEMA))


def test_vocabulary_table_is_sorted_per_column_without_null(spark):
    df = spark.createDataFrame([*DATA, (None, "Ghent", 1, 1.0)], SCHEMA)
    got = rows(encode.category_vocab(df, COLUMNS), "column", "position", "value", "n_rows")
    assert got == [
        ("grade", 0, "heavy", 2),
        ("grade", 1, "light", 2),
        ("grade", 2, "medium", 1),
        ("port", 0, "Bergen", 1),
        ("port", 1, "Ghent", 2),
        ("port", 2, "Turku", 3),
    ]


def test_a_limit_on_the_vocabulary_is_opt_in(spark):
    df = spark.range(20).selectExpr("cast(id as string) as c")
    assert len(encode.fit_vocabulary(df, ["c"])["c"]) == 20
    assert len(encode.fit_vocabulary(df, ["c"], limit=20)["c"]) == 20
    with pytest.raises(ValueError, match="more than 19"):
        encode.fit_vocabulary(df, ["c"], limit=19)


def test_fit_finds_sorted_categories_by_itself_however_many(spark):
    """More than 100,000 categories, each on one row, and one that explains the label."""
    n = 100_200
    df = spark.range(n).selectExpr(
        "if(id % 2 = 0, 'common', concat('rare', id)) as c", "cast(id % 2 as double) as y"
    )
    wide = spark.range(n).selectExpr("cast(id as string) as c", "0.0D as y")
    assert len(encode.encoding_stages(["c"], [])[0].fit(wide).labels) == n
    model = fit_tree(df, "y", ["c"], [], TreeSpec(max_depth=1, min_leaf=1))
    labels = model.stages[0].labels
    assert len(labels) == n // 2 + 1 and list(labels) == sorted(labels)
    assert score(model, df).where("predicted_demand <> y").count() == 0
    unseen = spark.createDataFrame([("new",), (None,)], "c string")
    assert {r["predicted_demand"] for r in score(model, unseen).collect()} == {1.0}


@pytest.mark.parametrize(
    "vocabulary", [{"a": ["b_c"], "a_b": ["c"]}, {"a": ["x", "X"]}, {"a": ["b"]}]
)
def test_names_that_meet_are_an_error(spark, vocabulary):
    df = spark.createDataFrame([("b_c", "c", 7.5)], "a string, a_b string, A_B_1 double")
    clash = vocabulary if "a_b" in vocabulary or "X" in vocabulary["a"] else {"a": ["b"]}
    with pytest.raises(ValueError, match="taken twice"):
        encode.one_hot_wide(df, clash)


def test_values_with_points_and_quotes(spark):
    df = spark.createDataFrame([("St. Louis",), ("a`b",)], "city string")
    vocabulary = encode.fit_vocabulary(df, ["city"])
    wide = encode.one_hot_wide(df, vocabulary)
    flags = wide.select(*encode.quoted(encode.one_hot_names(vocabulary)))
    assert flags.columns == ["city_St. Louis", "city_a`b"]
    assert rows(flags) == [(0, 1), (1, 0)]


UNSEEN = [("B", 1), ("Z", 2), (None, 3)]


def test_unseen_and_null_are_zeros_in_both_forms(spark, tmp_path):
    df = spark.createDataFrame(UNSEEN, "c string, id int")
    vocabulary = {"c": ["A", "B", "C"]}
    wide = encode.one_hot_wide(df, vocabulary)
    assert rows(wide, "id", "c_A", "c_B", "c_C") == [(1, 0, 1, 0), (2, 0, 0, 0), (3, 0, 0, 0)]
    encoder = encode.fit_encoder(df, vocabulary, ["id"])
    reloaded = load_model(save_model(encoder, str(tmp_path / "encoder")))
    for fitted in (encoder, reloaded):
        slots = encode.encoded_slots(fitted, df, ["c"])
        assert rows(slots, "id", "c_ones", "c_slot") == [(1, 1, 1), (2, 0, None), (3, 0, None)]


def test_design_matrix_is_numeric_first(spark):
    df = spark.createDataFrame(DATA[1:2], SCHEMA)
    vocabulary = {"grade": ["heavy", "light"], "port": ["Bergen"]}
    encoder = encode.fit_encoder(df, vocabulary, ["price", "litres"])
    vector = encoder.transform(df).first()["features"]
    assert list(vector.toArray()) == [2.25, 3.0, 0.0, 1.0, 1.0]


def test_missing_numbers_train_and_score(spark, tmp_path):
    data = [("A", float(i % 5) if i % 3 else None, 1.0 if i % 3 else 9.0) for i in range(90)]
    data += [("A", float("nan"), 9.0)]
    df = spark.createDataFrame(data, "c string, x double, y double")
    model = fit_tree(df, "y", {"c": ["A"]}, ["x"], TreeSpec(max_depth=3, min_leaf=2))
    reloaded = load_model(save_model(model, str(tmp_path / "tree")))
    scored = score(reloaded, df)
    assert scored.columns == ["c", "x", "y", "predicted_demand"]
    assert scored.where("predicted_demand <> y").count() == 0


def test_sparse_encoder_needs_no_list_of_categories(spark, tmp_path):
    from demandloom.operators import encode

    rows_ = [(k, f"v{k % 50:02d}", "x" if k % 3 else None) for k in range(500)]
    frame = spark.createDataFrame(rows_, "id int, a string, b string")
    encoder = encode.fit_sparse_encoder(frame.where("id < 40"), ["a", "b"])
    assert encoder.sizes == {"a": 40, "b": 1}
    encoder.save(str(tmp_path / "categories"))
    again = encode.SparseEncoder.load(spark, str(tmp_path / "categories"))
    assert dict(again.sizes) == dict(encoder.sizes)
    for row in again.transform(frame).collect():
        slot = row["id"] % 50
        assert row["a_onehot"].size == 40 and row["b_onehot"].size == 1
        assert list(row["a_onehot"].indices) == ([slot] if slot < 40 else [])
        assert list(row["b_onehot"].indices) == ([0] if row["b"] else [])
    with pytest.raises(ValueError, match="no category in b"):
        encode.fit_sparse_encoder(frame.where("b is null"), ["a", "b"])
    with pytest.raises(KeyError):
        encode.fit_sparse_encoder(frame, ["c"])
