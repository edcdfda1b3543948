"""Layer 1: column functions on the literal fixtures (FIXTURES.md A.9-A.13)."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from quartermaster.functions import columns as C
from quartermaster.operators.joins import map_lookup


def test_compose_version_fixture(spark):
    df = spark.createDataFrame([(4, 4, 0, "dev"), (4, 4, None, "dev"), (4, 3, 1, "stable")],
                               "major int, minor int, patch int, status string")
    got = C.compose_version(df).select("version", "version_dash", "version_dot").collect()
    assert [tuple(r) for r in got] == [("4.4", "4.4-dev", "4.4.dev"), ("4.4", "4.4-dev", "4.4.dev"),
                                       ("4.3.1", "4.3.1-stable", "4.3.1.stable")]


def test_compose_version_mono(spark):
    df = spark.createDataFrame([(4, 4, 0, "dev", True)], "major int, minor int, patch int, status string, m boolean")
    assert C.compose_version(df, mono="m").first().version_dot == "4.4.dev.mono"


def test_parse_package_fixture(spark):
    df = spark.createDataFrame([("/x/GameSharp.4.4.0-dev.7.nupkg",), ("p/Game.NET.Sdk.4.4.0.nupkg",),
                                ("Foo2.Bar.1.0.nupkg",), ("noversion.nupkg",)], "path string")
    got = [tuple(r) for r in C.parse_package(df, "path").select("name", "version_raw", "version").collect()]
    assert got == [("GameSharp", "4.4.0-dev.7", "4.4.0-dev.7"), ("Game.NET.Sdk", "4.4.0", "4.4.0"),
                   ("Foo2.Bar", "2.Bar.1.0", "1.0"), ("noversion", "", "")]


def test_split_ref_short_and_long_rows(spark):
    df = spark.createDataFrame([("game-linux:4.4-f41",), ("game-osx",), ("a:b:c",)], "line string")
    got = [tuple(r) for r in C.split_ref(df, "line").select("name", "tag").collect()]
    assert got == [("game-linux", "4.4-f41"), ("game-osx", ""), ("a", "b")]


def test_path_parts(spark):
    df = spark.createDataFrame([("out/linux/x86_64/game.zip",), ("plain.zip",)], "p string")
    got = C.path_parts(df, "p", suffix=".zip").collect()
    assert (got[0].base_name, got[0].dir_name, got[0].tail, got[0].stem) == \
        ("game.zip", "out/linux/x86_64", "linux/x86_64/game.zip", "game")
    assert (got[1].base_name, got[1].dir_name, got[1].tail, got[1].stem) == ("plain.zip", "", "", "plain")
    # the suffix is removed only at the end
    df2 = spark.createDataFrame([("a.zip.txt",)], "p string")
    assert df2.select(C.drop_suffix("p", ".zip").alias("s")).first().s == "a.zip.txt"


def test_compose_name_template_is_data(spark):
    df = spark.createDataFrame([("linux", "editor", "x86_64")], "platform string, target string, arch string")
    cols = dict(platform=F.col("platform"), target=F.col("target"), arch=F.col("arch"))
    r = df.select(C.compose_name("game.{platform}.{target}.{arch}", **cols).alias("a"),
                  C.compose_name("game.{platform}.{target}{arch}", **cols).alias("b")).first()
    assert (r.a, r.b) == ("game.linux.editor.x86_64", "game.linux.editorx86_64")


def test_default_if_empty(spark):
    df = spark.createDataFrame([("x",), ("",), (None,)], "v string")
    got = [r.d for r in df.select(C.default_if_empty("v", "dflt").alias("d")).collect()]
    assert got == ["x", "dflt", "dflt"]
    # coalesce alone keeps the empty string (the trap)
    assert [r.d for r in df.select(F.coalesce("v", F.lit("dflt")).alias("d")).collect()] == ["x", "", "dflt"]


def test_replace_first_only_first_and_regex(spark):
    df = spark.createDataFrame([("a/b a/b",), ("axb",), ("none",), ("",), (None,)], "v string")
    got = [r.o for r in df.select(C.replace_first("v", "a.b", "Z").alias("o")).collect()]
    assert got == ["Z a/b", "Z", "none", "", None]
    literal = [r.o for r in df.select(C.replace_first("v", re.escape("a/b"), "Z").alias("o")).collect()]
    assert literal[1] == "axb"


def test_replace_first_multibyte_text(spark):
    df = spark.createDataFrame([("😀é e1 e2",)], "v string")
    assert df.select(C.replace_first("v", "e[0-9]", "X").alias("o")).first().o == "😀é X e2"


def test_flags_from_type_fixture(spark):
    df = spark.createDataFrame([("all",), ("classical",), ("mono",), ("steam",)], "t string")
    got = [tuple(r) for r in C.flags_from_type(df, "t", ["classical", "mono"]).collect()]
    assert got == [("all", 1, 1), ("classical", 1, 0), ("mono", 0, 1), ("steam", 0, 0)]


def test_digest_manifest_glob_and_digest(spark):
    import hashlib
    files = [("Game_a.zip", b"A"), ("game-lib.aar", b"B"), ("SHA512-SUMS.txt", b"C"),
             ("mono/Game_b.zip", b"D")]
    df = spark.createDataFrame(files, "path string, content binary")
    got = C.digest_manifest(df, "path", "content", 512, name_glob="[Gg]*").collect()
    names = sorted(r.name for r in got)
    assert names == ["Game_a.zip", "game-lib.aar"]  # the glob does not recurse
    want = {p: hashlib.sha512(c).hexdigest() for p, c in files}
    assert all(r.digest == want[r.name] for r in got)


def test_glob_to_regex():
    rx = re.compile(C.glob_to_regex("[Gg]*"))
    assert rx.match("Game.zip") and rx.match("game") and not rx.match("SHA512-SUMS.txt")
    assert re.match(C.glob_to_regex("*.nupkg"), "a.b.nupkg") and not re.match(C.glob_to_regex("*.nupkg"), "a.nupkgx")
    assert re.match(C.glob_to_regex("[!a]?"), "bc") and not re.match(C.glob_to_regex("[!a]?"), "ac")
    assert not re.match(C.glob_to_regex("*"), "a/b")


def test_map_lookup_literal_and_table(spark):
    df = spark.createDataFrame([("linux",), ("osx",), ("nope",)], "t string")
    got = [tuple(r) for r in map_lookup(df, {"linux": "Linux", "osx": "macOS"}, "t").collect()]
    assert got == [("linux", "Linux"), ("osx", "macOS"), ("nope", None)]
    inner = map_lookup(df, {"linux": "Linux"}, "t", how="inner").collect()
    assert [r.t for r in inner] == ["linux"]


def test_replace_first_literal_pattern(spark):
    df = spark.createDataFrame([("/opt/a.b/x /opt/a.b/y",), ("/opt/axb/x",), ("q\\Eq",)], "v string")
    got = [r.o for r in df.select(C.replace_first("v", "/opt/a.b", "/new", literal=True).alias("o")).collect()]
    assert got == ["/new/x /opt/a.b/y", "/opt/axb/x", "q\\Eq"]
    odd = [r.o for r in df.select(C.replace_first("v", "\\E", "!", literal=True).alias("o")).collect()]
    assert odd[2] == "q!q"
