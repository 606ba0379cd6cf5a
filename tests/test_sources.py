from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from starfit.functions import to_double
from starfit.sources import MOVIE_FIELDS, RATING_FIELDS, read_delimited, stage, staging_path
from starfit.sources.delimited import write_delimited

RATING_LINES = [
    "1::122::5::838985046",
    "2::a b::3.5::1e3",
    "3::9::::5",
    "4::7",
    "5::8:::4::3.7",
    "6::3.9::2.5::1e3",
    "7::1::4::5::extra",
    "9999999999::1::4::5",
    "8::1::NaN::5",
]
MOVIE_LINES = [
    '1::"Quoted" One (1995)::Drama|Comedy',
    "2:: Lead space::",
    "3::Has, comma: and colon::Thriller",
    "4::No genres",
    "x::Title::Drama",
]


@pytest.fixture()
def written(tmp_path):
    def write(name, lines):
        path = tmp_path / name
        path.write_text("\n".join(lines) + "\n")
        return str(path)

    return write


def test_ratings_and_rejects(spark, written):
    parsed = read_delimited(spark, written("ratings.dat", RATING_LINES), RATING_FIELDS)
    assert parsed.good.dtypes == list(RATING_FIELDS)
    assert sorted(map(tuple, parsed.good.collect())) == [(1, 122, 5.0, 838985046), (6, 3, 2.5, 1000)]
    assert {r.line: r.reason for r in parsed.rejects.collect()} == {
        RATING_LINES[1]: "no number in movieId",
        RATING_LINES[2]: "no number in rating",
        RATING_LINES[3]: "no number in rating",
        RATING_LINES[4]: "no number in rating",
        RATING_LINES[6]: "too many fields",
        RATING_LINES[7]: "no number in userId",
        RATING_LINES[8]: "no number in rating",
    }


def test_movies_keep_quotes_and_spaces(spark, written):
    parsed = read_delimited(spark, written("movies.dat", MOVIE_LINES), MOVIE_FIELDS)
    assert sorted(map(tuple, parsed.good.collect())) == [
        (1, '"Quoted" One (1995)', "Drama|Comedy"),
        (2, " Lead space", ""),
        (3, "Has, comma: and colon", "Thriller"),
        (4, "No genres", ""),
    ]
    assert [r.line for r in parsed.rejects.collect()] == [MOVIE_LINES[4]]


def test_other_separators_are_literal(spark, written):
    path = written("piped.txt", ["1||2||3.5||4", "1|2|3.5|4"])
    parsed = read_delimited(spark, path, RATING_FIELDS, separator="||")
    assert parsed.good.count() == 1 and parsed.rejects.count() == 1


def test_write_and_read_back(spark):
    frame = spark.createDataFrame([(1, 2, 3.5, 4), (5, 6, 0.5, 8)], "userId int, movieId int, rating double, timestamp int")
    path = staging_path(spark, "back")
    write_delimited(frame, path, frame.columns)
    back = read_delimited(spark, path, RATING_FIELDS)
    assert sorted(back.good.collect()) == sorted(frame.collect()) and back.rejects.count() == 0


class FakeSession:
    """A session's settings, since a running one cannot change its checkpoint folder."""

    def __init__(self, master, conf=None, checkpoint_dir=None):
        self.conf = SimpleNamespace(get=lambda key, default: (conf or {}).get(key, default))
        self.sparkContext = SimpleNamespace(
            master=master, applicationId="app-1", getCheckpointDir=lambda: checkpoint_dir
        )


def test_numbers_are_digits(spark):
    """No type suffixes, named values or numbers past the range of doubles."""
    texts = ["5", " 5.5 ", "+.5", "5.", "1e3", "5f", "5d", "5D", "NaN", "Infinity", "-inf", "1e400", "0x10", "", "."]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", to_double(F.col("t")).alias("n"))
    assert {r.t: r.n for r in rows.collect() if r.n is not None} == {"5": 5, " 5.5 ": 5.5, "+.5": 0.5, "5.": 5, "1e3": 1000}


def test_staging_follows_the_session():
    named = FakeSession("spark://host:7077", {"spark.checkpoint.dir": "hdfs://shared/dir/"})
    assert staging_path(named, "x").startswith("hdfs://shared/dir/starfit/app-1/kept/x-")
    set_later = FakeSession("yarn", checkpoint_dir="hdfs://shared/later")
    assert staging_path(set_later, "x").startswith("hdfs://shared/later/starfit/app-1/kept/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging_path(FakeSession("yarn"), "x")


def test_staged_tables_read_back(spark):
    frame = spark.range(10).selectExpr("id", "id % 2 AS odd")
    back = stage(frame, "numbers", partition_by="odd")
    assert sorted(back.select("id", "odd").collect()) == sorted(frame.collect())
    assert back.filter("odd = 1").count() == 5


def test_unknown_field_type(spark, written):
    with pytest.raises(ValueError, match="no reader"):
        read_delimited(spark, written("a.dat", ["1"]), [("a", "map")])


def test_staged_tables_are_written_compactly(spark):
    frame = stage(spark.range(20_000).selectExpr("concat_ws('|', hash(id), hash(id + 7)) AS text"), "compact")
    names = frame.inputFiles()
    assert names and all(".zstd." in name for name in names)
