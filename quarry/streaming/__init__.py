"""Streaming.

The analysed pipeline has no streaming input, watermark, window or
stateful operator, so nothing is built here. The fitted cleaning and
encoding steps (``plans.clean.apply_cleaning``,
``ColumnTransformerModel.exprs``) are plain column expressions and can be
applied unchanged to a DataFrame from ``spark.readStream``.
"""
