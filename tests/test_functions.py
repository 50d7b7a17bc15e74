import pytest
from pyspark.sql import functions as F

from docloom.config import Settings, load_phase, load_settings
from docloom.functions import text, urls
from docloom.operators import admission


def _one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "url, reason, strict",
    [
        ("https://h/p/x.pdf", "non-html-extension:.pdf", False), ("https://h/p/DEFAULT.HTM", "shell-page:DEFAULT.HTM", True), ("https://h/p/en/825", None, False), ("https://h/libx/a.htm", "skip-path:lib", True),
        ("https://h/p/a.html?x=1#f", None, True), ("https://h/lib/a.htm", "skip-path:lib", False), ("https://h/p/GUID-0A1B2C3D-0A1B-0A1B-0A1B-0A1B2C3D4E5F.html", "guid-page", False), ("not a url .htm", None, True),
    ],
)
def test_admission(spark, url, reason, strict):
    assert _one(spark, admission.reject_reason(F.lit(url))) == reason
    assert _one(spark, admission.admitted_strictly(F.lit(url))) is strict


def test_url_functions(spark):
    page = F.lit("https://h/pub/foo/1.0/doc/html/Admin/file.htm")
    want = [
        (urls.output_path(page), "pub/foo/1.0/doc/html/Admin/file.md"),
        (urls.alias_url(page), "https://h/pub/foo/1.0/doc/html/Data/Alias.xml"),
        (urls.alias_url(F.lit("https://h/pub/foo/1.0/doc/adb/html/x.htm")), "https://h/pub/foo/1.0/doc/adb/Data/Alias.xml"),
        (urls.zip_url(F.lit("https://h/pub/dsp/7.2.0/a.htm"), F.lit("https://h/s/maker-foo-7-2-0.xml"), F.lit("7.2.0")), "https://h/pub/dsp/7.2.0/maker-foo-7-2-0_documentation.zip"),
        (urls.root_of_output(F.lit("pub/foo/1.0/adb/html/a/x.md")), "pub/foo/1.0/adb/html/"),
        (urls.with_suffix(F.lit("admin.4.01.htm"), ".md"), "admin.4.01.md"),
        (urls.with_suffix(F.lit("a/noext"), ".md"), "a/noext.md"),
        (urls.help_link(F.lit("../a/./b.htm#f")), "a/./b.htm"),
        (urls.resolve(F.lit("https://h/a/b/c.htm"), F.lit("../B/./z.htm#s")), "/a/B/z.htm"),
        (urls.relative_path(F.lit("p/A/x.md"), F.lit("p/B/C/z.md")), "../B/C/z.md"),
        (urls.relative_path(F.lit("p/A/x.md"), F.lit("p/A/y.md")), "y.md"),
        (urls.relative_path(F.lit("p/x.md"), F.lit("p/A/y.md")), "A/y.md"),
        (urls.relative_path(F.lit("x.md"), F.lit("y.md")), "y.md"),
        (urls.extension(F.lit("a/.hidden")), ""),
        (urls.extension(F.lit("a/und..html")), ".html"),
    ]
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, (c, _) in enumerate(want)]).first()
    assert list(row) == [v for _, v in want]
    assert _one(spark, urls.output_path(F.lit("https://h"))) is None


def test_text_functions(spark):
    want = [
        (text.clean_toc_path(F.lit("User Guide|[%=System.LinkedHeader%]")), "User Guide"),
        (text.clean_toc_path(F.lit(" A || B ")), "A|B"),
        (text.strip_tokens(F.lit("x [%=a.b%] y [%=c d%]")), "x  y "),
        (text.count_tokens(F.lit("x [%=a.b%] y [%=c d%]")), 2),
        (text.slugify(F.lit("™®")), "topic"),
        (text.slugify(F.lit("a" * 60)), "a" * 50),
        (text.slugify(F.lit("Important Information")), "important-information"),
        (text.slugify(F.lit("word " * 20)), "-".join(["word"] * 10)),
        (text.clean_markdown(F.lit("**Enter**to")), "**Enter** to\n"),
        (text.clean_markdown(F.lit("(**word** x")), "(** word** x\n"),
        (text.duration(F.lit(3661)), "1h 1m 1s"),
        (text.duration(F.lit(59)), "59s"),
        (text.duration(F.lit(3600)), "1h 0s"),
        (text.collapse(F.lit(" a  b\n")), "a b"),
        (text.topic_type(F.lit("x task concept")), "concept"),
        (text.title_head(F.lit("A - B - C")), "A"),
    ]
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, (c, _) in enumerate(want)]).first()
    assert list(row) == [v for _, v in want]
    once = text.clean_toc_path(F.lit(" A |[%=x%]| B"))
    assert _one(spark, text.clean_toc_path(once)) == _one(spark, once)


def test_settings_and_phases(tmp_path):
    (tmp_path / "s.yaml").write_text("issue_prefix: AB\ncontent_selectors: [main]\nunknown: 1\n")
    s = load_settings(tmp_path / "s.yaml")
    assert s.issue_prefix == "AB" and s.content_selectors == ("main",) and s.shell_pages == Settings().shell_pages
    (tmp_path / "p.yaml").write_text("name: first\nversions: [a, b]\n")
    assert load_phase("p", tmp_path / "none", tmp_path) == {"name": "first", "products": [], "versions": ["a", "b"]}
    with pytest.raises(FileNotFoundError):
        load_phase("q", tmp_path)
