"""The whole run, from landed files to the regime."""

from __future__ import annotations

import json
import subprocess
import sys
import tempfile
from pathlib import Path

import pytest

from tidemark import session as session_module
from tidemark.__main__ import main
from tidemark.fixed_values import SENTIMENT_LABELS
from tidemark.operators.quality import QualityError

DAY = 86400


def land(folder, ids):
    assets = [
        {
            "id": i, "symbol": s, "name": i, "current_price": 10.0 + n, "market_cap": cap,
            "market_cap_rank": n + 1, "fully_diluted_valuation": cap, "total_volume": cap / 20,
            "high_24h": 12.0 + n, "low_24h": 9.0 + n, "price_change_percentage_24h": n * 37 % 100 / 10 - 5.03,
            "price_change_percentage_7d_in_currency": n * 41 % 100 / 5 - 10.05,
            "price_change_percentage_30d_in_currency": n * 43 % 100 / 2 - 25.05,
            "circulating_supply": 5.0,
            "total_supply": 6.0, "max_supply": 7.0, "ath": 50.0 + n, "ath_change_percentage": -40.0,
            "ath_date": "2024-01-01T00:00:00Z", "atl": 1.0, "atl_date": "2020-01-01T00:00:00Z",
            "last_updated": "2024-02-01T09:00:00",
        }
        for n, (i, s, cap) in enumerate(ids)
    ]
    start = 1706745600  # 2024-02-01
    # the five zones in turn, 18 days each
    zones = list(zip((10, 30, 50, 60, 80), SENTIMENT_LABELS.labels))
    moods = [
        {
            "value": str(zones[d % 5][0]),
            "value_classification": zones[d % 5][1],
            "timestamp": str(start - d * DAY),
        }
        for d in range(90)
    ]
    totals = {
        "data": {
            "total_market_cap": {"usd": 2e12}, "total_volume": {"usd": 1e11},
            "market_cap_percentage": {"btc": 51.0, "eth": 17.0}, "active_cryptocurrencies": 9,
            "markets": 8, "market_cap_change_percentage_24h_usd": 1.5,
        }
    }
    trending = {
        "coins": [
            {"item": {"id": i, "name": i, "symbol": s, "market_cap_rank": 1, "score": n}}
            for n, (i, s, _) in enumerate(ids[:8])
        ]
    }
    files = {
        "assets": json.dumps(assets),
        "sentiment": json.dumps({"data": moods}),
        "global": json.dumps(totals),
        "trending": json.dumps(trending),
        "categories": "coin_id,category,subcategory\nbitcoin,Store of Value,Digital Gold\n",
    }
    for name, text in files.items():
        (folder / name).mkdir(parents=True)
        (folder / name / "part").write_text(text)


def snapshot(anchor):
    ids = [(anchor, "btc", 4 * 10**11), ("second", "eth", 15 * 10**10)]
    return ids + [(f"a{n}", f"s{n}", 10 ** (10 - n % 3)) for n in range(108)]


def test_run_from_landed_files(spark, tmp_path):
    land(tmp_path / "landing", snapshot("bitcoin")[:100])
    target = str(tmp_path / "tables")
    arguments = ["--landing", str(tmp_path / "landing"), "--target", target]
    stamp = ["--as-of", "2024-02-01 10:00:00"]
    main(arguments + stamp)  # all 321 checks hold, or it would stop
    regime = spark.read.parquet(f"{target}/market_regime").first()
    assert (regime.coins_analyzed, regime.fear_greed_current, regime.btc_dominance) == (50, 10, 51.0)
    assert spark.read.parquet(f"{target}/top_performers").count() == 60


def test_missing_anchor_blocks_the_staged_layer(spark, tmp_path):
    land(tmp_path / "landing", snapshot("other")[:100])
    target = tmp_path / "tables"
    with pytest.raises(QualityError, match="C02"):
        main(["--landing", str(tmp_path / "landing"), "--target", str(target),
              "--as-of", "2024-02-01 10:00:00"])
    assert (target / "raw_assets").exists()
    assert not (target / "assets").exists()


class _Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):  # noqa: N802
        return self.folder

    def setCheckpointDir(self, folder):  # noqa: N802
        self.folder = folder


class _Session:
    def __init__(self, master, configured=None):
        self.sparkContext = _Context(master)
        self.conf = {"spark.checkpoint.dir": configured} if configured else {}


def test_shared_folder_comes_from_the_session():
    cluster = _Session("yarn", "hdfs:///shared/")
    assert session_module.shared_dir(cluster) == "hdfs:///shared"
    assert cluster.sparkContext.folder == "hdfs:///shared/"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session_module.shared_dir(_Session("yarn"))
    assert session_module.shared_dir(_Session("local[2]")).startswith(tempfile.gettempdir())


def test_intermediate_tables_go_with_the_driver(tmp_path):
    script = (
        "from tidemark.session import get_spark, materialised\n"
        f"spark = get_spark('end', 'local[1]', **{{'spark.checkpoint.dir': '{tmp_path}',"
        " 'spark.ui.enabled': 'false'})\n"
        "assert materialised(spark.range(5)).count() == 5\n"
        f"import os; assert os.listdir('{tmp_path}/tidemark')\n"
        "spark.stop()\n"
    )
    root = Path(session_module.__file__).parents[1]
    subprocess.run([sys.executable, "-c", script], check=True, cwd=root, timeout=120)
    assert list((tmp_path / "tidemark").iterdir()) == []
