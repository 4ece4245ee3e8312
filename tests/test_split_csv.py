"""The splitting reader against Spark's own, on files made to confuse it."""

import random

import pytest
from pyspark.sql import functions as F

from tallywind.schemas import LABELLED_TEXT
from tallywind.session import new_folder
from tallywind.sources import files
from tallywind.sources.split_csv import records
from tests.helpers import rows

PIECES = ['"', '""', '"""', ",", "\n", "\n\n", "a", "b c"]
PIECES += ['","', '"\n"', '\n"', '",', "é", " ", "1"]


@pytest.fixture
def small_splits(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "512", "spark.sql.files.openCostInBytes": "0"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def both(spark, path, **options):
    whole = files.read_labelled_csv(spark, path, **options)
    return rows(files.read_labelled_csv(spark, path, split=True, **options)), rows(whole)


def fields(dice):
    """A text field, quoted as the format wants, with all that could mislead."""
    text = "".join(dice.choice(PIECES) for _ in range(dice.randint(0, 12)))
    return '"' + text.replace('"', '""') + '"'


def test_well_formed_files(spark, tmp_path, small_splits):
    dice = random.Random(1)
    for name in range(3):
        lines = []
        for i in range(300):
            cells = [dice.choice([fields(dice), "plain", "", 'o"dd', '""']) for _ in range(3)]
            lines.append(",".join([str(i), *cells]))
        for folder, ending in (("unix", "\n"), ("dos", "\r\n")):
            (tmp_path / folder).mkdir(exist_ok=True)
            (tmp_path / folder / f"{name}.csv").write_text(
                ending.join(lines) + ending, newline=""
            )
    for keep_empty in (False, True):
        split, whole = both(spark, str(tmp_path / "unix"), keep_empty=keep_empty)
        assert split == whole and len(whole) == 900
        # Spark's reader may take line ends inside quotes for those of the records.
        dos = str(tmp_path / "dos")
        found = files.read_labelled_csv(spark, dos, split=True, keep_empty=keep_empty)
        assert rows(found) == whole
    assert spark.read.text(str(tmp_path / "unix")).rdd.getNumPartitions() > 20


def test_one_record_over_many_splits(spark, tmp_path, small_splits):
    text = "line, with \"\"quotes\"\"\n" * 400
    (tmp_path / "a.csv").write_text(f'1,a,b,"{text}"\n2,c,d,e\n3,"x\ny",z,"{text}"\n')
    split, whole = both(spark, str(tmp_path))
    assert split == whole and len(whole) == 3


def test_quotes_that_never_end(spark, tmp_path, small_splits):
    tail = "\n".join("some line" for _ in range(200))
    (tmp_path / "a.csv").write_text(f'1,a,b,c\n2,d,e,"f\n{tail}')
    found = [r["record"] for r in records(spark, str(tmp_path)).collect()]
    assert sorted(found) == ["1,a,b,c", f'2,d,e,"f\n{tail}']


def test_odd_lines(spark, tmp_path):
    text = '\n\n1,a,b,c\n\n2,,"",\n3\n4,a,b,c,d,e\nx,"a"b,c"d"," e"\n,,,\n'
    (tmp_path / "a.csv").write_text(text)
    (tmp_path / "b.csv").write_text("")
    split, whole = both(spark, str(tmp_path), keep_empty=True)
    assert split == whole


def test_what_the_writer_writes(spark, small_splits):
    dice = random.Random(9)
    texts = [None, "", *("".join(dice.choices(PIECES, k=8)) for _ in range(200))]
    data = [(i, dice.choice(texts), dice.choice(texts), t) for i, t in enumerate(texts)]
    path = new_folder(spark, "written")
    df = spark.createDataFrame(data, LABELLED_TEXT)
    files.write_headerless_csv(df.coalesce(1), path)
    assert rows(files.read_labelled_csv(spark, path, keep_empty=True, split=True)) == rows(df)
    lines = spark.read.text(path).select(F.spark_partition_id().alias("p")).distinct()
    assert lines.count() > 3
