"""Spark-native analytics over timed text: caption cues, aligned words, model results and frame detections."""
