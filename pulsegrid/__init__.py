"""Population-health analytics on Spark: profiles, vital-sign readings, live feeds.

Every operator takes and returns DataFrames (batch or streaming) and starts no job
by itself; sinks and streaming starters are the only functions that act.
"""
