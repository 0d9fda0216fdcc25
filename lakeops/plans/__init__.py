"""The jobs users call: star-schema reports, the medallion ETL, the ticket
log, the table audit and the star-schema generator."""
