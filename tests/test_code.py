"""Source structure and diffs, by hand and against a walk over characters."""

from __future__ import annotations

import random

from corpusmill.operators import source

RUST = '''use std::fmt;

/// Adds.
#[inline]

// really
pub fn add<'a>(x: &'a str) -> usize {
    let s = "{ not a brace \\" }";
    let c = '{'; let q = '\\''; // }
    let r = r#"}"{"#; /* { */
    x.len()
}

impl<T> fmt::Display
    for Box<T>
{
    async fn show(&self) {
        if true { }
    }
    pub(crate) fn other() {}
}

mod tests {
    fn inner() { }
}
mod outer;
struct Unit;
enum Kind { A, B }'''.split("\n")


def blocks(spark, lines: list[str], path: str, kind: str = "function") -> list[tuple]:
    df = spark.createDataFrame([(1, path, "\n".join(lines))], "k int, path string, text string")
    return [tuple(r) for r in source.source_blocks(df, ["k"]).where(f"kind = '{kind}'").orderBy("first", "last").select("name", "first", "last", "signature").collect()]


def test_rust_functions_and_containers(spark):
    got = [x[:3] for x in blocks(spark, RUST, "a.rs")]
    assert got == [("add", 3, 12), ("show@impl <T> fmt::Display for Box<T>", 17, 19), ("other@impl <T> fmt::Display for Box<T>", 20, 20), ("inner", 24, 24)]
    kinds = [(x[3], x[1], x[2]) for x in blocks(spark, RUST, "a.rs", "container")]
    assert kinds == [("impl <T> fmt::Display for Box<T>", 14, 21), ("mod tests", 23, 25), ("struct Unit", 27, 28), ("enum Kind", 28, 28)]


def test_other_languages(spark):
    py = ["import os", "class A:", "    def f(self):", "        return 1", "", "# note", "    x = 2", "def g():", "    pass"]
    assert [x[:3] for x in blocks(spark, py, "a.py")] == [("A", 2, 7), ("f", 3, 6), ("g", 8, 9)]
    js = ["export function f(a) {", "  return {a}", "}", "const g = (x) => {", "}", "class K {", "}"]
    assert [x[:3] for x in blocks(spark, js, "src/a.ts")] == [("f", 1, 3), ("g", 4, 5), ("K", 6, 7)]
    toml = ["[package]", 'name = "x"', "[[bin]]", 'path = "y"']
    assert [x[1:3] for x in blocks(spark, toml, "a.toml")] == [(1, 2), (3, 4)]
    assert blocks(spark, ["x"], "a.md") == [] and blocks(spark, [""], "b.rs") == []


def walk(lines: list[str], at: int) -> int:
    depth, opened = 0, False
    for i in range(at, len(lines)):
        for ch in lines[i]:
            depth += (ch == "{") - (ch == "}")
            opened |= ch == "{"
            if ch == "}" and opened and depth == 0:
                return i + 1
    return len(lines)


def test_braces_against_a_walk(spark):
    r = random.Random(4)
    files = []
    for k in range(200):
        lines = ["".join(r.choice("{} a") for _ in range(r.randrange(6))) for _ in range(r.randrange(1, 9))]
        for at in r.sample(range(len(lines)), min(len(lines), 2)):
            lines[at] = f"function f{at}" + lines[at].replace("a", "")
        files.append((k, "x.js", lines))
    df = spark.createDataFrame([(k, p, "\n".join(x)) for k, p, x in files], "k int, path string, text string")
    got = {(r.k, r.first): r.last for r in source.source_blocks(df, ["k"]).collect()}
    want = {(k, i + 1): walk(x, i) for k, _, x in files for i, line in enumerate(x) if line.startswith("function")}
    assert got == want


SCHEMA = "k int, diff string, old map<string,string>, new map<string,string>"


def test_context_diff(spark):
    old = "\n".join(RUST)
    new = old.replace("    x.len()", "    x.len() + 1")
    diff = "diff --git a/src/a.rs b/src/a.rs\n--- a/src/a.rs\n+++ b/src/a.rs\n@@ -10,3 +10,3 @@\n     let r = 1;\n-    x.len()\n+    x.len() + 1\n }\ndiff --git a/x.bin b/x.bin\nBinary files a/x.bin and b/x.bin differ"
    df = spark.createDataFrame([(1, diff, {"src/a.rs": old}, {"src/a.rs": new}), (2, "plain", {}, {}), (3, None, None, None)], SCHEMA)
    got = {r.k: r.text for r in source.context_diff(df, ["k"]).collect()}
    assert got[2] == "plain" and got[3] is None
    body = got[1].split("\n")
    assert "@@ Function context: add @@" in body and "@@ -3,10 +3,10 @@" in body and " use std::fmt;" in body and "Binary files a/x.bin and b/x.bin differ" in body
    # Changes apart by more than five lines outside of functions are regions of their own; nearer ones are one.
    text = [f"l{i}" for i in range(1, 60)]
    changed = [*text[:9], "L10", *text[10:18], "L19", *text[19:49], "L50", *text[50:]]
    diff = "diff --git a/n.md b/n.md\n" + "\n".join(f"@@ -{i},1 +{i},1 @@\n-l{i}\n+L{i}" for i in (10, 19, 50))
    df = spark.createDataFrame([(1, diff, {"n.md": "\n".join(text)}, {"n.md": "\n".join(changed)})], SCHEMA)
    titles = [x for x in source.context_diff(df, ["k"]).first().text.split("\n") if x.startswith("@@")]
    assert titles == ["@@ -5,20 +5,20 @@", "@@ -5,20 +5,20 @@", "@@ -45,11 +45,11 @@"]


def test_readable_diff(spark):
    old = "\n".join(RUST)
    new = old.replace("    x.len()", "    x.len() + 1").replace("struct Unit;", "struct Unit { a: u8 }").replace("    fn inner() { }", "")
    diff = "diff --git a/src/a.rs b/src/a.rs\n@@ -11,1 +11,1 @@\n-    x.len()\n+    x.len() + 1\n@@ -24,1 +24,1 @@\n-    fn inner() { }\n+\n@@ -27,1 +27,1 @@\n-struct Unit;\n+struct Unit { a: u8 }"
    gone = "\ndiff --git a/b.py b/b.py\ndeleted file mode 100644\n@@ -1,2 +0,0 @@\n-def f():\n-    pass\ndiff --git a/c.md b/c.md\nnew file mode 100644\n@@ -0,0 +1,2 @@\n+hello\n+"
    df = spark.createDataFrame([(1, diff + gone, {"src/a.rs": old, "b.py": "def f():\n    pass"}, {"src/a.rs": new, "c.md": "hello\n"}), (2, None, {}, {})], SCHEMA)
    got = {(r.path, r.kind, r.name): (r.status, r.old_text, r.new_text) for r in source.readable_diff(df, ["k"]).collect()}
    add = "\n".join(RUST[2:12])
    assert got == {
        ("src/a.rs", "function", "add"): ("modified", add, add.replace("x.len()", "x.len() + 1")),
        ("src/a.rs", "function", "inner"): ("deleted", "    fn inner() { }", None),
        ("src/a.rs", "container", "Unit"): ("modified", "struct Unit;\nenum Kind { A, B }", "struct Unit { a: u8 }"),
        ("b.py", "function", "f"): ("deleted", "def f():\n    pass", None),
        ("c.md", "outside", None): ("new", None, "hello"),
    }


def test_changed_numbers(spark):
    df = spark.createDataFrame([(1, "diff --git a/a b/b\nnew file mode 100644\n@@ -1,2 +5,3 @@ fn x\n a\n-b\n+c\n+d\n e")], "k int, diff string")
    rows = source.diff_lines(df, ["k"]).orderBy("no").collect()
    assert [r.kind for r in rows] == ["new"] * 5
    assert [r.new_no for r in rows if r.sign == "+"] == [6, 7] and [r.old_no for r in rows if r.sign == "-"] == [2]


def test_windows_hold_as_much_of_a_large_table(spark, monkeypatch):
    text = "\n".join(RUST)
    df = spark.createDataFrame([(k, "a.rs", text) for k in range(100)], "k int, path string, text string")
    monkeypatch.setattr(source, "PART", 5 * len(text), raising=False)
    got = source.source_blocks(df, ["k"])
    assert got.rdd.getNumPartitions() == 20
    assert got.count() == 100 * len(blocks(spark, RUST, "a.rs") + blocks(spark, RUST, "a.rs", "container"))


def test_diffs_are_dealt_by_size(spark, monkeypatch):
    diff = "diff --git a/n.md b/n.md\n@@ -1,1 +1,1 @@\n-a\n+b"
    df = spark.createDataFrame([(k, diff, {"n.md": "a"}, {"n.md": "b"}) for k in range(60)], SCHEMA)
    monkeypatch.setattr(source, "PART", 6 * len(diff), raising=False)
    text = source.context_diff(df, ["k"])
    assert text.rdd.getNumPartitions() == 10
    assert {r.text.count("@@ -1,1 +1,1 @@") for r in text.collect()} == {1}
    monkeypatch.setattr(source, "PART", 12, raising=False)
    versions = source.readable_diff(df, ["k"])
    assert versions.rdd.getNumPartitions() == 10
    assert {tuple(r)[1:] for r in versions.collect()} == {("n.md", "outside", None, "modified", "a", "b")} and versions.count() == 60
