"""Card-payment analytics on Spark: raw tables -> star schema -> business reports."""
