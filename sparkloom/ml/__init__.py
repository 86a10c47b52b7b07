"""Feature engineering, models, forecasts and text preparation on DataFrames."""
