"""Query registry (name -> Spark job over a data folder) and the SQL oracle."""
