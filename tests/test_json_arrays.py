"""Array files cut by byte ranges, against ``json.load`` of the whole files."""
import json
import random

import pytest

from threadscope.sources import json_arrays as A


def value(rng, depth=0):
    kind = rng.randrange(8 if depth < 4 else 5)
    if kind == 0:
        return rng.choice([0, -1, 3.5, 1e30, True, False, None])
    if kind < 5:
        return "".join(rng.choice('ab"\\{}[],: \n中😀') for _ in range(rng.randrange(12)))
    if kind == 5:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {value(rng, 9) if isinstance(x := value(rng, 9), str) and x else f"k{i}": value(rng, depth + 1) for i in range(rng.randrange(5))}


def key_text(v):
    """Dict keys must be strings for JSON."""
    if isinstance(v, dict):
        return {str(k): key_text(x) for k, x in v.items()}
    return [key_text(x) for x in v] if isinstance(v, list) else v


@pytest.fixture
def small_ranges(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[1], "1")
    yield lambda n: spark.conf.set(names[0], str(n))
    for n, v in before.items():
        spark.conf.set(n, v)


def read(spark, folder):
    elements, report = A.array_elements(spark, [str(folder)])
    name = lambda p: p.rsplit("/", 1)[1]
    found = [(name(r.file_path), r.pos, json.loads(r.value)) for r in elements.collect()]
    return sorted(found, key=lambda r: r[:2]), {(name(r.file_path), r.pos): r.reason for r in report.collect()}


def expected(folder):
    out, bad = [], set()
    for f in sorted(folder.iterdir()):
        try:
            data = json.loads(f.read_bytes().decode())
            if not isinstance(data, list):
                raise ValueError
            out += [(f.name, i, v) for i, v in enumerate(data) if isinstance(v, dict)]
        except ValueError:
            bad.add(f.name)
    return out, bad


@pytest.mark.parametrize("size", [150, 1 << 20])
def test_ranges_of_any_size_give_the_files_elements(spark, tmp_path, small_ranges, size):
    rng = random.Random(size)
    for n in range(4):
        data = [key_text(value(rng)) for _ in range(rng.randrange(20))] + [{"a": "}" * 50, "b": {"c": [{}, {"d": "]"}]}}] * (n % 3)
        (tmp_path / f"{n}.json").write_text(json.dumps(data, ensure_ascii=bool(n % 2), indent=n % 4 or None), encoding="utf-8")
    whole = (tmp_path / "3.json").read_text()
    broken = {"cut": whole[:len(whole) // 2], "tail": whole + " x", "comma": "[{},]", "gap": '[{"a": 1},,{"b": 2}]', "object": '{"a": 1}',
              "end": "[{}}", "two": "[{}] [{}]", "quote": '["a', "mixed": '[{"a": [1}, 2]]', "string": '"[{}]"', "number": "7", "brace": "}",
              "none": "", "word": "[{}, nul]", "control": '[{"a": "\x01"}]', "up": "]", "missing": "[, {}]"}
    for n, text in broken.items():
        (tmp_path / f"{n}.json").write_text(text, encoding="utf-8")
    (tmp_path / "bytes.json").write_bytes(b'[{"a": "\xff"}]')
    (tmp_path / "blank.json").write_text(" [ ] \n")
    small_ranges(size)
    found, report = read(spark, tmp_path)
    want, bad = expected(tmp_path)
    assert bad >= {f"{n}.json" for n in broken}
    assert found == want
    assert {f for f, pos in report if pos is None} == bad - {"none.json"} and all(report.values())
    if size < 400:
        fragments = A._fragments(spark, [str(tmp_path)], "*.json")
        assert fragments.rdd.getNumPartitions() > 8  # a file is many tasks' work


def test_records_that_a_variant_would_lose(spark, tmp_path, small_ranges):
    deep = 5000
    text = '[{"a": 1, "a": 2}, {"a": NaN, "b": -Infinity, "c": 1e999}, {"a": 1, "b": ' + "[" * deep + "]" * deep + '}, {"s": "\\ud800"}]'
    (tmp_path / "odd.json").write_text(text)
    small_ranges(1 << 20)
    found, report = read(spark, tmp_path)
    assert report == {} and [v for _, _, v in found[:2]] == [{"a": 2}, {"a": None, "b": None, "c": None}]
    deepest = found[2][2]["b"]
    levels = 0
    while isinstance(deepest, list):
        deepest, levels = deepest[0], levels + 1
    assert found[2][2]["a"] == 1 and levels + deepest.count("[") == deep
    assert len(found) == 4


def test_too_large_records_are_reported(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(A, "VARIANT_BYTES", 100)
    (tmp_path / "a.json").write_text(json.dumps([{"a": 1}, {"a": "x" * 200}]))
    rows = [r for b in A._cut({})(iter([_batch(tmp_path / "a.json")])) for r in b.to_pylist()]
    assert [(r["idx"], r["kind"]) for r in rows] == [(0, "object"), (1, "large"), (1, "range")] and rows[1]["reason"]


def _batch(path):
    import pyarrow as pa
    values = path.read_bytes().split(b"}")
    return pa.RecordBatch.from_arrays([pa.array([str(path)] * len(values)), pa.array([0] * len(values), pa.int64()), pa.array(values, pa.binary()),
                                       pa.array([False] * len(values))], ["file_path", "block", "value", "shared"])


def test_states_of_ranges():
    parts = ['[{"a": "x', 'y}', 'z}"}, {"b": 1}', "]"]
    rows = []
    for n, part in enumerate(parts):
        import numpy as np
        inside, delta = A.structure(np.frombuffer(part.encode(), np.uint8))
        rows.append(("f", n, bool(inside[-1]), int(delta[~inside].sum()), int(delta[inside].sum())))
    assert A.range_states(rows) == {("f", 0): (False, 0, False), ("f", 1): (True, 2, False), ("f", 2): (True, 2, False), ("f", 3): (False, 1, True)}


@pytest.mark.parametrize("step", [1, 2, 7])
def test_steps_of_any_size_give_the_elements(monkeypatch, step):
    import pyarrow as pa
    monkeypatch.setattr(A, "STEP", step)
    rng = random.Random(step)
    for _ in range(40):
        whole = [key_text(value(rng)) for _ in range(rng.randrange(6))]
        data = json.dumps(whole, ensure_ascii=rng.random() < 0.5).encode()
        assert b"".join(A.steps(data)) == data
        values = data.split(b"}")
        batch = pa.RecordBatch.from_pydict({"file_path": ["f"] * len(values), "block": [0] * len(values), "value": pa.array(values, pa.binary()),
                                            "shared": [False] * len(values)})
        rows = [r for b in A._cut({})(iter([batch])) for r in b.to_pylist()]
        assert [(r["idx"], json.loads(r["value"])) for r in rows if r["kind"] == "object"] == [(i, v) for i, v in enumerate(whole) if isinstance(v, dict)]
        assert not [r for r in rows if r["kind"] == "bad"] and rows[-1]["value"] == A._ONE_ARRAY
    escapes = rb'"\\\\\\\"\\" \"'
    assert all((len(p) - len(p.rstrip(b"\\"))) % 2 == 0 for p in A.steps(escapes))


def test_arrays_over_a_batch_are_small():
    """A batch of 32 MB, once with many records and once with few, is cut with less than its size besides it."""
    import tracemalloc

    import pyarrow as pa
    for n, size in ((10_000, 3 << 10), (4, 8 << 20)):
        data = json.dumps([{"a": "x, [y" * (size // 5)}] * n).encode()
        values = data.split(b"}")
        batch = pa.RecordBatch.from_pydict({"file_path": ["f"] * len(values), "block": [0] * len(values), "value": pa.array(values, pa.binary()),
                                            "shared": [False] * len(values)})
        del data, values
        for run in (A._cut({}), A._summaries):
            tracemalloc.start()
            assert sum(b.num_rows for b in run(iter([batch]))) == (n + 1 if run is not A._summaries else 1)
            peak = tracemalloc.get_traced_memory()[1]
            tracemalloc.stop()
            assert peak < 80 << 20, peak


def test_texts_are_written_from_their_batch(tmp_path, monkeypatch):
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa
    import pyspark

    from threadscope.sources.json_sink import ArrayWriter
    monkeypatch.setattr(pyspark.TaskContext, "get", staticmethod(lambda: SimpleNamespace(partitionId=lambda: 0, taskAttemptId=lambda: 0)))
    texts = pa.array([json.dumps({"n": i, "t": "中😀" * 1000}, ensure_ascii=False) for i in range(2000)])
    batch = pa.RecordBatch.from_arrays([pa.array([None] * 1000 + ["b"] * 1000), texts], ["folder", "j"])
    tracemalloc.start()
    done = ArrayWriter(str(tmp_path), True).write(iter([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 << 20 < texts.nbytes, peak
    assert [json.loads((tmp_path / f).read_text(encoding="utf-8")) for f in done.files] == [[json.loads(t) for t in texts.to_pylist()][i:i + 1000] for i in (0, 1000)]
