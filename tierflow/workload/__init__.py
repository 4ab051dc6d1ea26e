"""The library's operators applied to the benchmark tables.

`tables`  reads them in the roles of the pipeline's own tables
`queries` applies one operator, sink or flow per entry
`oracle`  states the same results as SQL
"""
