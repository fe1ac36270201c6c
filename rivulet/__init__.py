"""rivulet: event-stream analytics as DataFrame -> DataFrame functions on Spark."""
