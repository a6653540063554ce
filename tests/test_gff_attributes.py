"""Attributes are found by plain searches: no lambda runs for each attribute of a line."""

from exonloom.sources import lines as L


def test_attributes_of_odd_lines(spark):
    attrs = {
        "ID=a;Parent=p,q;Name=n": ("a", ["p", "q"], "n", None, []), " ID=a ;  Parent=p ; ;Name= n x ;": ("a", ["p"], " n x", None, []),
        "ID=a;ID=b;XID=c": ("b", None, None, None, []), "product=x;Product=y": (None, None, None, "y", []), "description=d;product=x%2C+1;Product=": (None, None, None, "", []),
        "Product=y;description=50% off;note=k,l": (None, None, None, "50% off", ["k", "l"]), "Note=a;note=b;Note=c": (None, None, None, None, ["c"]),
        "ID=;Name==v=w": ("", None, "=v=w", None, []), "id=low;.": (None, None, None, None, []), "product=a+b%3B;ID=x": ("x", None, None, "a+b;", []), "": (None, None, None, None, [])}
    rows = [(f"c\ts\tgene\t{i}\t9\t.\t+\t.\t{a}",) for i, a in enumerate(attrs)]
    df = L.parse_gff3(spark.createDataFrame(rows, "value string"))
    got = {r["start"]: (r["id"], r["parents"], r["name"], r["product"], r["notes"]) for r in df.collect()}
    assert got == dict(enumerate(attrs.values()))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan
