"""The query of the rejects reads every record, and rejects the broken documents only."""

from fareflow.plans import bindings, lake
from fareflow.sources.payload import read_trade_payload
from tests.conftest import SMALL


def test_good_documents_stand_beside_the_broken(spark, monkeypatch):
    folders, made = [], lake.new_folder
    monkeypatch.setattr(lake, "new_folder", lambda *args: folders.append(made(*args)) or folders[-1])
    rejects = lake.payload_rejects(spark, SMALL)
    trade = bindings.trade(spark, SMALL, "year", "month")
    assert rejects.count() == 3 * trade.distinct().count()
    good = read_trade_payload(spark, f"{folders[0]}/*/*", lake.PAYLOAD_NAMES, on_error="skip")
    assert good.count() == trade.count() > 0
    whole = rejects.groupBy("year", "month", "reason").count()
    assert whole.filter("count > 1").isEmpty()
