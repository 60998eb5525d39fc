import json
import uuid

from peakloom.plans.records import POINTS
from peakloom.streaming.deliveries import PAYLOADS, deliveries, flatten_into


def test_files_are_appended_once(spark, tmp_path):
    inner = {"l_retention_times": [[1, 2]], "l_mass_to_charges": [[1, 2]], "l_intensities": [[1, None]]}
    send = lambda k: spark.createDataFrame([(k, "r", None, json.dumps({"features": [inner]}))], PAYLOADS).write.mode("append").parquet(str(tmp_path / "in"))
    name = uuid.uuid4().hex
    for k in (1, 2):
        send(k)
        flatten_into(deliveries(spark, str(tmp_path / "in")), POINTS, str(tmp_path / "out"), name).awaitTermination(60)
    assert sorted(r.batch_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2]
