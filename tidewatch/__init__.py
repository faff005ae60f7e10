"""tidewatch: data-reliability monitoring of event tables on Spark."""
