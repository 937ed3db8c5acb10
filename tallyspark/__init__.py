"""Invoice analytics on Spark: documents -> bronze -> silver -> star schema -> spend queries."""
