"""DataFrame operators, grouped by the stage of the pipeline that uses them."""
