"""School data lake on Spark: landed JSON pages in, a replace-by-slice warehouse and its reports out."""
