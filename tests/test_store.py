"""The versioned tile store: what is written is read, edits touch their tiles only, failures leave no trace."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from kerbline.functions import geom as G
from kerbline.operators import facilities as FA, viewport as VP
from kerbline.plans import changes
from kerbline.sources import store as ST
from kerbline.streaming import edits as ES
from queries.editing import straight_network
from tests.test_changes import edits_of

TILE_M = 700.0
BOX = (-122.49, 37.7005, -122.475, 37.7025)  # degrees, in the small network


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def saved(city, tmp_path_factory):
    net = straight_network(city)
    store = ST.NetworkStore(city.spark, tmp_path_factory.mktemp("store").as_uri(), tile_m=TILE_M)
    assert store.head() is None and store.save(net) == 1
    return net, store


def test_every_table_is_read_as_it_was_written(saved):
    net, store = saved
    got = ST.tables_of(store.read())
    for name, df in ST.tables_of(net).items():
        assert rows(got[name]) == rows(df), name
    whole = FA.facility_ends(net.facilities, net.segments, net.crosswalks)
    assert rows(store.read().facility_ends) == rows(whole)


def test_boxes_enclose_what_is_in_a_row(saved):
    _, store = saved
    seg = store.table("segments")
    b = seg.withColumn("b", G.bbox(F.col("utm"))).where("b.x0 <> min_x OR b.y0 <> min_y OR b.x1 <> max_x OR b.y1 <> max_y")
    assert b.isEmpty()
    f = store.table("facilities").join(seg.select("seg_id", F.col("min_x").alias("m")), "seg_id").where("m <> min_x")
    assert f.isEmpty()


def test_a_viewport_reads_its_folders_only(saved):
    net, store = saved
    seen = store.viewport(BOX)
    plan = seen.segments._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "PushedFilters: [" in plan and "LessThanOrEqual(min_x" in plan
    files, every = len(seen.segments.inputFiles()), len(store.table("segments").inputFiles())
    assert len(store.tiles_in(store.metric_box(BOX))) < store.manifest(1).where("name = 'segments' AND tile IS NOT NULL").count()
    assert 0 < files <= every
    for zoom in (12.0, 16.0, 18.2):
        def shown(n):
            return rows(VP.viewport_features(n.segments.drop("incline"), n.facilities, n.crosswalks, n.ramps, n.calming, BOX, zoom).select("t", "fid", "color", "off"))
        assert shown(seen) == shown(net) and shown(seen)


def far_edit(net):
    s = net.segments.orderBy("seg_id").first()
    return s, edits_of(net.segments.sparkSession, {"edit_type": "attr_edit", "seg_id": s["seg_id"], "col": "name", "new_value": "Elsewhere"},
                       {"edit_type": "delete_point", "node_id": s["end_node"]})


def test_an_edit_rewrites_touched_tiles_only_and_once(city, tmp_path):
    net = straight_network(city)
    store = ST.NetworkStore(city.spark, tmp_path.as_uri(), tile_m=TILE_M)
    store.save(net)
    s, edits = far_edit(net)
    assert store.apply(edits, 4) == 2 and store.head() == (2, 4)
    m = store.manifest(2).where("tile IS NOT NULL")
    kept, new = m.where("data_version = 1").count(), m.where("data_version = 2").count()
    assert 0 < new < kept
    touched = {r["tile"] for r in m.where("data_version = 2").select("tile").collect()}
    assert touched <= set(store.reach(edits, 1))
    whole = changes.apply_changeset(net, edits)
    got = store.read()
    for name in ("segments", "ramps", "crosswalks", "hulls", "members", "slots", "sidewalks"):
        keys = [c for c in ("seg_id", "side", "pos", "n", "hull_id", "node_id", "face", "name", "start_is_intersection", "end_is_intersection") if c in getattr(whole, name).columns]
        assert rows(getattr(got, name).select(*keys)) == rows(getattr(whole, name).select(*keys)), name
    assert store.apply(edits, 4) == 2 and store.apply(edits, 3) == 2  # delivered again: nothing happens
    assert rows(store.read(1).segments.select("seg_id", "name")) == rows(net.segments.select("seg_id", "name"))  # the version before is still there


def test_a_failed_attempt_leaves_the_version_before(city, tmp_path, monkeypatch):
    net = straight_network(city)
    store = ST.NetworkStore(city.spark, tmp_path.as_uri(), tile_m=TILE_M)
    store.save(net)
    _, edits = far_edit(net)
    kind = type(net.segments)
    real = kind.coalesce

    def fail(self, n):
        raise OSError("lost")

    monkeypatch.setattr(kind, "coalesce", fail)
    with pytest.raises(OSError):
        store.apply(edits, 1)
    monkeypatch.setattr(kind, "coalesce", real)
    assert store.head() == (1, None) and rows(store.read().segments.select("seg_id", "name")) == rows(net.segments.select("seg_id", "name"))
    assert store.apply(edits, 1) == 2
    assert store.table("segments").where("name = 'Elsewhere'").count() == 1 and store.table("segments").count() == net.segments.count()


def test_a_stream_killed_and_replayed_gives_the_same_network(city, tmp_path):
    spark, net = city.spark, straight_network(city)
    s = [r for r in net.segments.orderBy("seg_id").limit(3).collect()]
    for i, r in enumerate(s):
        edits_of(spark, {"edit_id": i + 1, "edit_type": "attr_edit", "seg_id": r["seg_id"], "col": "name", "new_value": f"S{i}"}).coalesce(1).write.parquet(f"{tmp_path}/log/{i}")
    stream = spark.readStream.schema(spark.read.parquet(f"{tmp_path}/log/0").schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/log")
    store = ST.NetworkStore(spark, f"{tmp_path.as_uri()}/store", tile_m=TILE_M)
    store.save(net)
    calls = []

    def dies(batch, batch_id):
        store.sink()(batch, batch_id)
        calls.append(batch_id)
        if len(calls) == 2:
            raise RuntimeError("killed after the batch was stored, before the stream knew")

    q = ES.run(stream, str(tmp_path / "state"), dies)
    with pytest.raises(Exception, match="killed"):
        q.awaitTermination()
    ES.run(stream, str(tmp_path / "state"), dies).awaitTermination()
    assert calls.count(calls[1]) == 2 and store.head()[0] == 4  # three batches, each stored once
    names = {r["seg_id"]: r["name"] for r in store.table("segments").where(F.col("seg_id").isin([r["seg_id"] for r in s])).collect()}
    assert names == {r["seg_id"]: f"S{i}" for i, r in enumerate(s)}


def test_regions_are_built_once_or_again(city, tmp_path):
    net = straight_network(city)
    none = {t: getattr(net, t).where("false") for t in ST.PLACES if t != "segments" and not t.startswith("override_")}
    net = replace(net, segments=net.segments.orderBy("seg_id").limit(30), **none)
    built = []

    def maker(name):
        def make():
            built.append(name)
            return net
        return make

    makers = {"east": maker("east"), "west": maker("west")}
    path = tmp_path.as_uri()
    assert ST.build_regions(city.spark, path, {"east": makers["east"]}) == {"east": 1}
    assert ST.build_regions(city.spark, path, makers) == {"east": 1, "west": 1} and built == ["east", "west"]
    assert ST.build_regions(city.spark, path, {"west": makers["west"]}, skip_existing=False) == {"west": 2} and built[-1] == "west"
    east = ST.NetworkStore(city.spark, f"{path}/region=east")
    assert east.head() == (1, None) and east.table("segments").count() == net.segments.count()
