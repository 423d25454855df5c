"""Queries over the driver's tables and the SQL they are checked against.

``frames`` derives the raw flight, weather, position and airspace tables from
``lineitem`` and ``events``; ``queries`` runs the library on them; ``oracle`` holds
independent SQL for the same questions.
"""
