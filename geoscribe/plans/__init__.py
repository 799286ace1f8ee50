"""Query plans built from the operators: the driver-table catalogue and the
reference's own tasks on the 13-field post table."""
