"""Query plans over the input tables (``queries``) and their SQL twins (``oracle``)."""
