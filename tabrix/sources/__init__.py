"""Sources and sinks: table readers, holdout carving, submission writers, the campaign view."""
