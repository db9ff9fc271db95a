"""Plans: table DDL, the run-audit log and the layered pipeline."""
