"""Command line flows on local files."""

from strata.__main__ import main

LISTING = """<pre><A HREF="/pub/">[To Parent Directory]</A><br>
 8/6/2026  8:30 AM          5 <A HREF="/pub/x/pr.a">pr.a</A><br>
 8/6/2026  8:31 AM          3 <A HREF="/pub/x/pr.b">pr.b</A><br>
 1/2/2026  9:05 AM        512 <A HREF="/pub/x/readme.txt">readme.txt</A><br></pre>"""


def test_ingest_twice(spark, tmp_path):
    listing = tmp_path / "listing.html"
    listing.write_text(LISTING)
    landed = tmp_path / "landed"
    landed.mkdir()
    (landed / "pr.a").write_bytes(b"12345")
    args = ["--local", "ingest", "--listing", str(listing), "--base-url", "https://h.org/pub/x/",
            "--landed-dir", str(landed), "--log-table", "cli_log", "--source", "SERIES"]
    assert main(args + ["--now", "2026-08-07T00:00:00"]) == {"NEW": 2}
    # pr.b failed to land: still NEW on the next run (retried); pr.a is unchanged
    (landed / "pr.b").write_bytes(b"xyz")
    assert main(args + ["--now", "2026-08-08T00:00:00"]) == {"NEW": 1, "UNCHANGED": 1}
    assert main(args + ["--now", "2026-08-09T00:00:00"]) == {"UNCHANGED": 2}


def test_medallion_command(spark, tmp_path):
    import json

    from tests.test_medallion import DIMS, HEADER_OBS, OBS_LINES, POPULATION, SERIES

    series_root, ctx_root = tmp_path / "series", tmp_path / "ctx"
    series_root.mkdir()
    ctx_root.mkdir()
    (series_root / "pr.data.1.AllData").write_text(HEADER_OBS + "\n".join(OBS_LINES) + "\n")
    (series_root / "pr.series").write_text(SERIES)
    for name, text in DIMS.items():
        (series_root / name).write_text(text)
    (ctx_root / "population.json").write_text(json.dumps(POPULATION))
    out = main(["--local", "medallion", "--series-root", str(series_root), "--context-root", str(ctx_root),
                "--database", "cli_medallion"])
    assert "gold_best_year" in out["tables"]
    assert out["quality"]["silver_observations"]["failed_valid_observation"] == 3
