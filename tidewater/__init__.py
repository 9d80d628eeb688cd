"""tidewater: Spark-native engine for customer-campaign analytics.

Layers:
    functions/  Column -> Column helpers (text, booleans, ids, money, dates, segments)
    operators/  DataFrame -> DataFrame operators (quality splits, point-in-time
                aggregation, global ranks, statistics, uplift learning)
    sources/    scans, sinks, catalog registration and the bronze fixtures
    plans/      end-to-end plans: bronze -> silver -> gold -> causal -> scores
    streaming/  file-source incremental ingest with the same cleaning plan
"""

from tidewater.session import Params, get_session, checkpoint_dir

__all__ = ["Params", "get_session", "checkpoint_dir"]
