"""Array files cut into byte ranges: equal to the whole-file reader, whatever the cut."""

import json
import random
import tempfile

import pytest
from helpers import rows

from tableops.sources import json_split, read_json_array, read_large_json_array
from tableops.sources.ranges import byte_ranges, list_files

SCHEMA = "a bigint, b string, c struct<d:array<int>,e:string>"


class Bytes:
    def __init__(self, data):
        self.data, self.read = data, 0

    def read_at(self, n, at):
        self.read += n
        return self.data[at : at + n]


def split(data, step):
    """Both passes over ranges of ``step`` bytes, without Spark."""
    state, depth, out, read = 0, 0, [], 0
    for begin in range(0, len(data), step):
        end = min(begin + step, len(data))
        f = Bytes(data)
        out += json_split.elements(f, begin, end, len(data), state, depth, step=max(step, 4))
        read += f.read
        state, change = json_split.effect(data[begin:end], state)
        depth += change
    assert (state, depth) == (0, 0)
    return out, read


def values(rng, n):
    texts = ['"', "\\", '\\"', "[", "]{", "},", "é", "日", ",", '{"x":[', "\\\\", "\n", "", "plain"]
    word = lambda: "".join(rng.choice(texts) for _ in range(rng.randrange(5)))
    return [{"a": i, "b": word(), "c": {"d": list(range(rng.randrange(4))), "e": word()}} for i in range(n)]


@pytest.mark.parametrize("step", [1, 2, 3, 7, 64, 100_000])
@pytest.mark.parametrize("ascii_only", [True, False])
def test_every_cut_gives_the_same_elements(step, ascii_only):
    rng = random.Random(step)
    data = values(rng, 25)
    for text in (json.dumps(data, ensure_ascii=ascii_only), json.dumps(data, indent=2, ensure_ascii=ascii_only), " \n[ ]\n", "[1]", '[ "a]" , [ ] ]'):
        found, _ = split(text.encode(), step)
        assert [json.loads(x) for x in found] == json.loads(text)


def test_ranges_within_one_element_have_no_elements():
    text = json.dumps([{"b": "x" * 5000}, {"b": "y"}]).encode()
    found, read = split(text, 500)
    assert len(found) == 2 and read < 3 * len(text)


@pytest.mark.parametrize("text", ['[{"a": 1}', '[{"a": "x]', '[{"a": 1}, {"a"'])
def test_unfinished_files_fail(spark, text):
    base = tempfile.mkdtemp(prefix="json-split-")
    with open(f"{base}/x.json", "w") as f:
        f.write(text)
    with pytest.raises(Exception, match="does not end"):
        read_large_json_array(spark, base, SCHEMA, 4).collect()


def test_an_object_is_no_array(spark):
    base = tempfile.mkdtemp(prefix="json-split-")
    with open(f"{base}/x.json", "w") as f:
        f.write('{"a": 1, "b": 2}')
    with pytest.raises(Exception, match="where an array is expected"):
        read_large_json_array(spark, base, SCHEMA).collect()


def test_equals_the_whole_file_reader_in_several_tasks(spark):
    base = tempfile.mkdtemp(prefix="json-split-")
    rng = random.Random(4)
    for name, n, indent in (("one", 4000, None), ("two", 10, 1), ("none", 0, None)):
        with open(f"{base}/{name}.json", "w") as f:
            json.dump(values(rng, n), f, ensure_ascii=False, indent=indent)
    spark.createDataFrame([(json.dumps(values(rng, 7)),)], "value string").write.option("compression", "gzip").text(f"{base}/packed")
    open(f"{base}/empty.json", "w").close()
    got = read_large_json_array(spark, base, SCHEMA, 32 << 10)
    assert rows(got) == rows(read_json_array(spark, base, SCHEMA))
    assert got.count() == 4017
    ranges = byte_ranges(list_files(spark, f"{base}/one.json"), 32 << 10)
    assert ranges.count() > 5 and ranges.rdd.getNumPartitions() == 4


def test_elements_that_are_no_objects(spark):
    base = tempfile.mkdtemp(prefix="json-split-")
    with open(f"{base}/x.json", "w") as f:
        f.write('[null, {"a": 1}, {"a": "no number"}, {}]')
    got = read_large_json_array(spark, base, SCHEMA, 5)
    assert sorted([r["a"] for r in got.collect()], key=str) == [1, None, None, None]
