"""Plans: star schema, BI marts, warehouse loads, the batch job, the query registry."""
