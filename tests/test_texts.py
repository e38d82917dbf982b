from corvid.sources import python_ast, python_flow, reports


def test_copies_of_a_text_are_parsed_once_and_told_of_every_file(spark, tmp_path):
    seen = str(tmp_path / "seen")

    def rows_of(path, tree, text):
        with open(seen, "a") as f:
            f.write(".")
        return [(path, len(tree.body))]

    texts = ["a = 1\n", "a = 1\nb = 2\n", None, "", "no python ("]
    files = spark.createDataFrame([(f"f{i}.py", texts[i % 5]) for i in range(50)], "path string, text string").repartition(5)
    got = python_ast.parse_rows(files, rows_of, "path string, n int").collect()
    assert sorted(tuple(r) for r in got) == sorted((f"f{i}.py", (1, 2, 0, 0)[i % 5]) for i in range(50) if i % 5 < 4)
    assert len(open(seen).read()) == 3  # two texts, and one for the empty and the null ones


def test_flow_of_copies_is_that_of_each_file(spark):
    text = "def f(a):\n    b = a\n    while b:\n        b = b - 1\n    return b\n"
    files = spark.createDataFrame([("x.py", text), ("y.py", text), ("z.py", text + "\n")], "path string, text string")
    whole = python_flow.data_flow(files)
    rows = {p: sorted(tuple(r)[1:] for r in whole.where(f"path = '{p}'").collect()) for p in ("x.py", "y.py", "z.py")}
    assert rows["x.py"] and rows["x.py"] == rows["y.py"] == rows["z.py"] and whole.count() == 3 * len(rows["x.py"])
    by_function, by_block = python_flow.flow_metrics(files)
    assert {r["path"] for r in by_function.collect()} == {"x.py", "y.py", "z.py"} and by_function.count() == 3
    assert len({r["n"] for r in by_block.groupBy("path").count().withColumnRenamed("count", "n").collect()}) == 1


def test_files_read_in_one_split_are_dealt_to_all_tasks(spark):
    files = spark.createDataFrame([(f"c{i}.json", "{}") for i in range(40)], "path string, text string").coalesce(1)
    assert reports.config_values(files).rdd.getNumPartitions() == 4
