import gzip
import json
import random

import pytest

from caredeck.sources import json_objects
from caredeck.sources.readers import read_reference

from .test_jobs import write


def whole_file(text):
    decoder, at, records = json.JSONDecoder(), 0, []
    while at < len(text):
        if text[at].isspace():
            at += 1
            continue
        record, at = decoder.raw_decode(text, at)
        records.append((str(record["document_id"]), record["content"]))
    return sorted(records)


def objects(n, seed):
    draw = random.Random(seed)
    parts = ["{", "}", '"', "\\", "\\\\", "\n", "ç", " ", "[", "]", "a", "}\n{", '\\"}', " "]
    for i in range(n):
        content = "".join(draw.choice(parts) for _ in range(draw.randrange(60)))
        extra = {"more": {"deep": [{"x": content[:5]}]}} if draw.random() < 0.3 else {}
        record = {"document_id": f"d{i}", "content": content, **extra}
        yield json.dumps(record, ensure_ascii=draw.random() < 0.5, indent=draw.choice([None, 0, 2])) + draw.choice(["", "\n", " \n\n"])


def parts_read(spark, path):
    runs = spark.read.option("lineSep", "}").text(path)
    return runs.rdd.getNumPartitions()


@pytest.fixture
def small_parts(spark):
    """Parts of 300 bytes, so that most objects cross one."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "300")
    yield
    for n, value in before.items():
        spark.conf.set(n, value)


def test_one_file_by_many_tasks(spark, tmp_path, small_parts):
    text = "".join(objects(300, 3))
    path = write(tmp_path / "r.json", text)
    assert parts_read(spark, path) > 40
    assert sorted(tuple(r) for r in read_reference(spark, path).collect()) == whole_file(text)


def test_objects_longer_than_parts_and_several_files(spark, tmp_path, small_parts):
    (tmp_path / "in").mkdir()
    texts = ["".join(objects(40, 5)) + "\n", json.dumps({"document_id": 1, "content": '{"}\\' * 3000}) * 2, " \n ", ""]
    for i, text in enumerate(texts):
        write(tmp_path / "in" / f"{i}.json", text)
    (tmp_path / "in" / "z.json.gz").write_bytes(gzip.compress(texts[0].encode()))
    want = sorted(row for text in [*texts, texts[0]] for row in whole_file(text))
    assert sorted(tuple(r) for r in read_reference(spark, str(tmp_path / "in")).collect()) == want


@pytest.mark.parametrize(
    "bad", ['{"document_id": "1", "content": "x"', '{"document_id": "1", "content": "x"}}', '{"document_id": "1", "content": "x"} y',
            '{"document_id": "1", "content": {"x": 1}\n', '{"document_id": "1"}', "[1]", '{"document_id": "1", "content": "x}'],
)
def test_anything_but_objects_fails(spark, tmp_path, bad):
    good = '{"document_id": "0", "content": "ok"}\n'
    with pytest.raises(Exception, match="(?i)json|key|index|string|expect"):
        read_reference(spark, write(tmp_path / "bad.json", good + bad)).collect()


def test_effects_compose():
    draw = random.Random(7)
    for _ in range(2000):
        text = "".join(draw.choice('{}"\\a') for _ in range(draw.randrange(30)))
        cut = draw.randrange(len(text) + 1)
        for state in range(3):
            whole = json_objects.walk(text, state)
            half = json_objects.walk(text[:cut], state)
            assert json_objects.walk(text[cut:], *half) == whole
