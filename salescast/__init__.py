"""salescast — retail sales analytics and forecasting on Spark DataFrames.

Layout:
    sources/    typed readers / writers, test views over the driver tables
    functions/  Column-level calendar and scalar functions, fixed lookup values
    operators/  DataFrame operators: cleaning, joins, windows, aggregates,
                star schema, measures, security, forecasts, ml/
    plans/      end-to-end plans and the query catalogue used by the driver
    streaming/  Structured Streaming scoring job
"""

from salescast.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
