"""Streaming: intentionally empty.

The modelled application works on one competitor snapshot and has no
stream, watermark, window or state anywhere, so nothing here is built.
A new snapshot is a new batch run of ``tariff_engine.plans.marts``.
"""
