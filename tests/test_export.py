import glob
import os
import tempfile

from linkloom.sources.export import export_categories, read_export


def test_csv_form_and_order(spark):
    rows = [("b,c", "x"), ('q"uote', None), ("", "empty"), (None, "nourl"), ("  a ", "sp"), ("a", "other")]
    df = spark.createDataFrame(rows, "url string, pred_category string")
    out = os.path.join(tempfile.mkdtemp(prefix="linkloom-csv-"), "export")
    export_categories(df, out, single_file=True)
    text = open(glob.glob(os.path.join(out, "part-*.csv"))[0], encoding="utf-8").read()
    assert text.splitlines() == [
        "url,pred_category",
        '"",empty',
        "  a ,sp",
        "a,other",
        '"b,c",x',
        '"q""uote",',
        ",nourl",
    ]
    back = {(r.url, r.pred_category) for r in read_export(spark, out).collect()}
    assert back == set(rows)


def test_multi_file_export_is_globally_sorted(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/pages.parquet").select("url", "page_id").selectExpr(
        "url", "cast(page_id as string) as pred_category")
    out = os.path.join(tempfile.mkdtemp(prefix="linkloom-csv-"), "export")
    export_categories(df.repartition(5), out)
    urls = []
    for f in sorted(glob.glob(os.path.join(out, "part-*.csv"))):
        urls += [line.split(",")[0] for line in open(f, encoding="utf-8").read().splitlines()[1:]]
    assert urls == sorted(urls) and len(urls) == df.count()
