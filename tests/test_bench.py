"""The headline list keeps the queries of the first round."""

import bench


def test_headline_holds_textrank():
    assert "S8_textrank_summary" in bench.HEADLINE
