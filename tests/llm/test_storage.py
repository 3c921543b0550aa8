"""What goes to a Python worker at once, and what it gives back."""

from __future__ import annotations

import subprocess
import sys
from collections.abc import Iterator
from pathlib import Path

import corpus_pipeline
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.llm import byte_bpe, langid, pii, storage

ROWS, LONG = 3000, 10_000


def largest(frame) -> tuple[int, int]:
    """Bytes of the largest batch, and all rows."""

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], names=["bytes", "rows"])

    return frame.mapInArrow(sizes, "bytes long, rows long").agg(F.max("bytes"), F.sum("rows")).first()


@pytest.fixture
def session(spark):
    """A session without a limit of its own."""
    own = spark.newSession()
    own.conf.unset(storage.BATCH_LIMIT)
    return own


def texts(session):
    return session.range(0, ROWS, 1, 1).select("id", F.repeat(F.lit("x"), LONG).alias("text"))


def test_batches_of_long_texts_are_bounded(session):
    found = storage.written(texts(session), "long-texts")
    most, rows = largest(found.coalesce(1))
    assert rows == ROWS
    assert most < 2 * storage.BATCH_BYTES < ROWS * LONG


def test_longer_rows_go_alone(session):
    found = storage.written(session.range(0, 2, 1, 1).select(F.repeat(F.lit("y"), 2 * storage.BATCH_BYTES).alias("text")), "longer")
    most, rows = largest(found.coalesce(1))
    assert rows == 2
    assert 2 * storage.BATCH_BYTES <= most < 3 * storage.BATCH_BYTES


def test_a_limit_of_the_session_stays(session):
    session.conf.set(storage.BATCH_LIMIT, "1000000")
    storage.written(texts(session), "long-texts")
    assert session.conf.get(storage.BATCH_LIMIT) == "1000000"


GIVEN_BACK = """
import re
import pyarrow as pa
from rollbook.llm.arrowtext import release

def held():
    return sum(map(int, re.findall(r"\\nAnonymous:\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024

release()
before = held()
arrays = [pa.array(["x" * 1000] * 4000) for _ in range(40)]
most = held()
del arrays
release()
print(most - before, held() - before)
"""


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="reads the system's count of a process's memory")
def test_memory_of_arrow_is_given_back():
    out = subprocess.run([sys.executable, "-c", GIVEN_BACK], capture_output=True, text=True, check=True, cwd=storage.SOURCE)
    most, left = map(float, out.stdout.split())
    assert most > 150
    assert left < 75


class Frame:
    """Keeps the function that would go to the workers."""

    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])

    def mapInArrow(self, work, schema):  # noqa: N802
        return work


BATCH = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["Some words, some more of them.", None]})


def test_words_of_byte_bpe_end_with_the_task():
    own = byte_bpe.encoder(public_tokenizers.path(byte_bpe.RANKS), public_tokenizers.PATTERN)
    work = byte_bpe.encode(Frame(), decoded="decoded")
    first, again = (list(work(iter([BATCH]))) for _ in range(2))
    assert first == again and first[0].num_rows == 2
    assert not own.place and not len(own.flat)


def test_words_of_the_field_end_with_the_task():
    work = pii.find(Frame(), redact="text")
    first, again = (list(work(iter([BATCH]))) for _ in range(2))
    assert first == again and first[0].num_rows == 2
    assert not pii.trained().place


class Stop(Exception):
    pass


def test_first_stage_has_the_environment_of_the_others(spark, monkeypatch):
    environment = spark.sparkContext.environment
    monkeypatch.setitem(environment, "PYTHONPATH", "/elsewhere")

    def judged(*args, **kwargs):
        raise Stop(environment["PYTHONPATH"])

    monkeypatch.setattr(langid, "judged", judged)
    docs = spark.createDataFrame([(1, "a text", "en")], "doc_id long, text string, lang string")
    with pytest.raises(Stop, match=storage.SOURCE):
        corpus_pipeline.identify_language(spark, docs, "/nowhere")
