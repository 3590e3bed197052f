import csv
import glob

import pytest

from opinia.functions.text import TokenizerConfig
from opinia.operators import explore, materialize, naive_bayes
from opinia.operators.classifiers import ClassifierSettings
from opinia.plans.training import TextSettings, prepare_terms, train_and_export
from opinia.sources import readers, writers
from opinia.streaming.score import score_stream


def written(path):
    rows = []
    for part in sorted(glob.glob(f"{path}/part-*.csv")):
        with open(part, encoding="utf-8", newline="") as f:
            rows += list(csv.DictReader(f))
    return rows


@pytest.fixture
def reviews_file(tmp_path):
    path = tmp_path / "development.csv"
    path.write_text(
        'text,class\n"Ottimo, ""davvero""\nbello",pos\nNA,neg\n"",neg\n"Perché 👍",pos\n', encoding="utf-8"
    )
    return str(path)


def test_csv_reader(spark, reviews_file):
    rows = readers.read_development_csv(spark, reviews_file).orderBy("doc_id").collect()
    assert [(r["text"], r["class"]) for r in rows] == [
        ('Ottimo, "davvero"\nbello', "pos"), ("NA", "neg"), (None, "neg"), ("Perché 👍", "pos"),
    ]
    assert readers.read_evaluation_csv(spark, reviews_file).columns == ["text", "doc_id"]


def test_csv_reader_finds_columns_by_name(spark, tmp_path):
    path = tmp_path / "e.csv"
    path.write_text("doc_id,other,class,text\n7,x,pos,ciao\n", encoding="utf-8")
    row = readers.read_development_csv(spark, str(path)).first()
    assert (row["doc_id"], row["text"], row["class"]) == (7, "ciao", "pos")
    path.write_text("body\nciao\n", encoding="utf-8")
    with pytest.raises(ValueError):
        readers.read_evaluation_csv(spark, str(path))


def test_prediction_sink(spark, tmp_path):
    predictions = spark.createDataFrame([(i * 7 % 101, f"c{i * 7 % 101}") for i in range(50)], "doc_id long, predicted string")
    writers.write_predictions_csv(predictions, str(tmp_path / "out"))
    rows = written(tmp_path / "out")
    assert [int(r["Id"]) for r in rows] == list(range(50))
    assert [int(r["Predicted"][1:]) for r in rows] == sorted(i * 7 % 101 for i in range(50))


def test_itemset_and_log_sinks(spark, tmp_path):
    sets = spark.createDataFrame([(["a", "b"], 0.5)], "items array<string>, support double")
    writers.write_itemsets_csv(sets, str(tmp_path / "sets"))
    assert written(tmp_path / "sets") == [{"support": "0.5", "itemsets": "a,b"}]
    log = spark.createDataFrame([("knn", 0.9)], "classifier string, f1_weighted double")
    for append in (True, False, True):
        writers.write_experiment_log(log, str(tmp_path / "log"), append)
    assert written(tmp_path / "log") == [{"CLASSIFIER": "knn", "F1_WEIGHTED": "0.9"}] * 2


def test_train_and_export(spark, reviews, tmp_path):
    new = spark.createDataFrame([(1, "camera pulita ottima"), (2, "sporca scortese rumore")], "doc_id long, text string")
    train_and_export(reviews, new, str(tmp_path / "out"), settings=ClassifierSettings(loss="hinge", C=3.0, min_df=1, max_iter=15))
    assert written(tmp_path / "out") == [{"Id": "0", "Predicted": "pos"}, {"Id": "1", "Predicted": "neg"}]


def test_stream_scores_like_a_table(spark, reviews, tmp_path):
    text = TextSettings(TokenizerConfig(), (1, 1))
    model = naive_bayes.fit_naive_bayes(prepare_terms(reviews, text))
    new = reviews.select("doc_id", "text")
    new.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("doc_id long, text string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    score_stream(stream, model, str(tmp_path / "out"), str(tmp_path / "state"), text).awaitTermination()
    streamed = {r["doc_id"]: r["predicted"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert streamed == {r["doc_id"]: r["predicted"] for r in model.predict(prepare_terms(new, text)).collect()}
    assert len(streamed) == 30


def test_checkpoint_folder_comes_from_the_session(spark):
    assert spark.conf.get("spark.checkpoint.dir") in materialize.checkpoint_folder(spark)
    assert materialize.materialize(spark.range(3)).count() == 3


def test_frequent_itemsets_are_writable(reviews, tmp_path):
    sets = explore.frequent_itemsets(reviews, 0.4)
    writers.write_itemsets_csv(sets, str(tmp_path / "sets"))
    assert {r["itemsets"] for r in written(tmp_path / "sets")} >= {"camera", "ottima", "personale"}


def test_rows_of_several_files_are_numbered_in_file_order(spark, tmp_path):
    sizes = {"a": 3, "b": 40, "c": 1, "d": 12}
    for name, n in sizes.items():
        (tmp_path / f"{name}.csv").write_text("text,class\n" + "".join(f'"{name}\n{i}",pos\n' for i in range(n)), encoding="utf-8")
    rows = readers.read_development_csv(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [r["doc_id"] for r in rows] == list(range(56))
    assert [r["text"] for r in rows] == [f"{name}\n{i}" for name, n in sizes.items() for i in range(n)]
