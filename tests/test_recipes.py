from pyspark.sql import functions as F

from tessera.functions import recipes

PAGE = """<div><span class="wname">Gun</span></div>
<div class="support-ship-table"><table><tr><td><div class="support-ship"><img src="5.png"><div class="kind1"><span class="enable"></span><span></span><span></span><span></span><span></span><span></span><span class="enable"></span></div>Alpha</div></td>
<td><div class="support-ship"><div class="kind1"><span class="enable"></span></div>-</div></td></tr></table></div>
<div class="resource-table"><table><tr><th>h</th></tr><tr><th>h</th></tr>
<tr><th class="title resource-title">r</th></tr><tr><td><span>10</span><span>20</span><span>0</span><span>5</span></td></tr>
<tr><th class="border-right">0 ～ 5</th><td>1/2</td><td>3/4</td><td>Tube × 2<div class="sub">二番艦：Beta 限定</div><div title="1:Radar">Radar × 3</div></td></tr>
<tr><th class="border-right" rowspan=2>6 ～ 9</th><td>5/6</td><td>7/8</td><td>-</td></tr>
<tr><td><span>★8</span><span class="s-gap"><a title="Bolt"><img> 4</a></span></td></tr>
<tr><th class="kind1"><span class="remodel-info">x</span></th></tr>
<tr><th class="border-right" rowspan=2>MAX</th><td>9/9</td><td>8/8</td><td><div><figure title="3:Tube"></figure><figcaption>× 2</figcaption><figure title="Medal"></figure><figcaption>x 1</figcaption></div></td></tr>
<tr><td><div><a title="t"><div>Big Gun ★3</div></a></div></td></tr></table></div>"""


def test_rows_of_a_recipe_page():
    rows = recipes.recipe_rows(PAGE)
    assert [(r["action"], r["first"], r["last"], r["only"]) for r in rows] == [("resource", None, None, None), ("improve", 0, 5, None), ("improve", 0, 5, "Beta"), ("improve", 6, 6, None), ("improve", 7, 7, None), ("improve", 8, 8, None), ("upgrade", 10, 10, None)]
    assert rows[0]["costs"] == [10, 20, 0, 5] and rows[1]["costs"] == [1, 2, 3, 4]
    assert rows[1]["materials"] == [{"name": "Tube", "count": 2}] and rows[2]["materials"] == [{"name": "Radar", "count": 3}]
    assert rows[4]["materials"] == [] and rows[5]["materials"] == [{"name": "Bolt", "count": 4}]
    assert rows[6]["materials"] == [{"name": "Tube", "count": 2}, {"name": "Medal", "count": 1}]
    assert (rows[6]["group"], rows[6]["target"], rows[6]["target_level"]) == ("kind1", "Big Gun", 3)


def test_assistants_of_a_page(spark):
    assert recipes.assistant_rows(PAGE) == [{"source_order": 0, "group": "kind1", "name": "Alpha", "picture": "5.png", "mask": 65}, {"source_order": 1, "group": "kind1", "name": None, "picture": None, "mask": 1}]
    df = spark.createDataFrame([(PAGE,), (None,), ("<p>",)], "h string")
    assert [r[0] for r in df.select(F.size(recipes.recipes(F.col("h")))).collect()] == [7, 0, 0]
    assert df.select(F.explode(recipes.assistants(F.col("h")))).count() == 2


def test_names_and_counts():
    assert recipes.name_and_count("Gun × 3") == ("Gun", 3) and recipes.name_and_count("Gun") == ("Gun", 0)
    assert recipes.name_and_count("Gun × 2 二番艦：B 限定") == ("Gun", 2)
